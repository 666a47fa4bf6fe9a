"""The published Snowball English stemmer as one native column expression.

A step needs its input several times. Binding the input as a lambda variable keeps the whole
expression linear in the number of steps, however often the optimizer inlines it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words with a stem of their own, and words that are left as they are.
SPECIAL_STEMS = {
    "skis": "ski",
    "skies": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "idly": "idl",
    "gently": "gentl",
    "ugly": "ugli",
    "early": "earli",
    "only": "onli",
    "singly": "singl",
}
UNCHANGED = "sky news howe atlas cosmos bias andes".split()
UNCHANGED_AFTER_PLURAL = "inning outing canning herring earring proceed exceed succeed".split()

# Suffix -> replacement, by step. Longest match wins.
STEP_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent",
    "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate",
    "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous", "ousness": "ous",
    "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og",
    "fulli": "ful", "lessli": "less", "li": "",
}
STEP_3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic",
    "ful": "", "ness": "", "ative": "",
}
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism",
    "ate", "iti", "ous", "ive", "ize", "ion",
]
# These suffixes count only after one of the given letters.
LETTERS_BEFORE = {"ogi": "l", "li": "cdeghkmnrt", "ion": "st"}

VOWEL, OTHER = "[aeiouy]", "[^aeiouy]"
# The first region starts after the first vowel and non-vowel, or after one of three fixed beginnings.
REGION_1 = f"^(?>gener|commun|arsen|.*?{VOWEL}{OTHER})"
REGION_2 = f"{REGION_1}.*?{VOWEL}{OTHER}"
SHORT_SYLLABLE = f"(?:^{VOWEL}{OTHER}|{OTHER}{VOWEL}[^aeiouywxY])$"



def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), 0)


def _without_last(word: Column, n: int | Column) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _lookup(table: dict[str, str], key: Column) -> Column:
    """Value of `key`, or null."""
    entries = ", ".join(f"'{part}'" for item in table.items() for part in item)
    return F.try_element_at(F.expr(f"map({entries})"), key)


def _on_suffix(
    s: Column, suffixes: Iterable[str], body: Callable[[Column, Column], Column]
) -> Column:
    """`body` of the longest of `suffixes` that the word ends with (or an empty one) and what stands before it.

    The search finds the leftmost start, which is the longest suffix; most words are spared it
    by their last letter.
    """
    last_letters = "".join(sorted({suffix[-1] for suffix in suffixes}))
    guarded = [f"(?<=[{LETTERS_BEFORE[x]}]){x}" if x in LETTERS_BEFORE else x for x in suffixes]
    longest = F.regexp_extract(s, f"(?:{'|'.join(guarded)})$", 0)
    found = F.when(s.rlike(f"[{last_letters}]$"), longest).otherwise("")
    return _bind(found, lambda suffix: body(suffix, _without_last(s, F.length(suffix))))


def _prepare(word: Column) -> Column:
    """Straight apostrophes, none in front, and a capital Y where y is a consonant."""
    bare = F.regexp_replace(F.translate(word, "‘’‛", "'''"), "^'", "")
    marked = F.regexp_replace(F.regexp_replace(bare, "^y", "Y"), f"({VOWEL})y", "$1Y")
    return F.when(bare.contains("y"), marked).otherwise(bare)


def _possessive(s: Column) -> Column:
    cut = F.when(s.endswith("'s'"), 3).when(s.endswith("'s"), 2).when(s.endswith("'"), 1).otherwise(0)
    return _without_last(s, cut)


def _region_start(s: Column, pattern: str) -> Column:
    return F.coalesce(
        F.nullif(F.length(F.regexp_extract(s, pattern, 0)), F.lit(0)), F.length(s)
    )


def _plural(s: Column) -> Column:
    return (
        F.when(s.endswith("ied") | s.endswith("ies"), _without_last(s, F.when(F.length(s) > 4, 2).otherwise(1)))
        .when(~s.endswith("s"), s)
        .when(s.endswith("sses"), _without_last(s, 2))
        .when(s.rlike(f"{VOWEL}.*[^us]s$") & s.rlike(f"{VOWEL}.+s$"), _without_last(s, 1))
        .otherwise(s)
    )


def _past_and_progressive(state: Column) -> Column:
    s, r1 = state["s"], state["r1"]

    def body(suffix: Column, base: Column) -> Column:
        repaired = (
            F.when(base.rlike("(?:at|bl|iz)$"), F.concat(base, F.lit("e")))
            .when(base.rlike("(?:bb|dd|ff|gg|mm|nn|pp|rr|tt)$"), _without_last(base, 1))
            .when((F.length(base) <= r1) & base.rlike(SHORT_SYLLABLE), F.concat(base, F.lit("e")))
            .otherwise(base)
        )
        return (
            F.when(
                suffix.isin("eed", "eedly"),
                F.when(F.length(base) >= r1, F.concat(base, F.lit("ee"))).otherwise(s),
            )
            .when((suffix != "") & base.rlike(VOWEL), repaired)
            .otherwise(s)
        )

    return _on_suffix(s, ["eedly", "ingly", "edly", "eed", "ing", "ed"], body)


def _final_y(state: Column) -> Column:
    s = state["s"]
    return F.when(s.rlike(f".{OTHER}[yY]$"), F.concat(_without_last(s, 1), F.lit("i"))).otherwise(s)


def _region_of(state: Column, suffix: Column, suffixes: Iterable[str], second_region: Iterable[str]) -> Column:
    if not second_region:
        return state["r1"]
    if set(second_region) == set(suffixes):
        return state["r2"]
    return F.when(suffix.isin(list(second_region)), state["r2"]).otherwise(state["r1"])


def _derivational(
    replacements: dict[str, str], second_region: Iterable[str] = ()
) -> Callable[[Column], Column]:
    """Replace the longest matching suffix if it lies in the first region, or the second for some."""

    def step(state: Column) -> Column:
        def body(suffix: Column, base: Column) -> Column:
            start = _region_of(state, suffix, replacements, second_region)
            inside = (suffix != "") & (F.length(base) >= start)
            new = F.concat(base, _lookup(replacements, suffix)) if any(replacements.values()) else base
            return F.when(inside, new).otherwise(state["s"])

        return _on_suffix(state["s"], replacements, body)

    return step


def _final_e_and_l(state: Column) -> Column:
    s = state["s"]
    base, at = _without_last(s, 1), F.length(s) - 1
    drop_e = s.endswith("e") & (
        (at >= state["r2"]) | ((at >= state["r1"]) & ~base.rlike(SHORT_SYLLABLE))
    )
    drop_l = s.endswith("ll") & (at >= state["r2"])
    return F.when(drop_e | drop_l, base).otherwise(s)


def _apply(state: Column, step: Callable[[Column], Column]) -> Column:
    return _bind(
        state, lambda t: F.struct(step(t).alias("s"), t["r1"].alias("r1"), t["r2"].alias("r2"))
    )


def _suffix_steps(marked: Column, plural: Column) -> Column:
    state = F.struct(
        plural.alias("s"),
        _region_start(marked, REGION_1).alias("r1"),
        _region_start(marked, REGION_2).alias("r2"),
    )
    for step in (
        _past_and_progressive,
        _final_y,
        _derivational(STEP_2),
        _derivational(STEP_3, ["ative"]),
        _derivational(dict.fromkeys(STEP_4, ""), STEP_4),
        _final_e_and_l,
    ):
        state = _apply(state, step)
    return F.translate(state["s"], "Y", "y")


def english_stem(word: Column) -> Column:
    """Stem of a lower-case word.

    Words of two characters or fewer are their own stem. All others are stemmed, whatever their
    length; digits and other marks in them count as non-vowels.
    """

    def stem(marked: Column) -> Column:
        return _bind(
            _bind(_bind(marked, _possessive), _plural),
            lambda plural: F.when(plural.isin(UNCHANGED_AFTER_PLURAL), plural).otherwise(
                _suffix_steps(marked, plural)
            ),
        )

    as_it_is = (F.length(word) < 3) | word.isin(UNCHANGED)
    return F.when(as_it_is, word).otherwise(
        F.coalesce(_lookup(SPECIAL_STEMS, word), _bind(_prepare(word), stem))
    )
