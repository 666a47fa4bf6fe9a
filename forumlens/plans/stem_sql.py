"""The stemmer's rules as SQL for another engine, one step per table expression."""

from __future__ import annotations

# Fixed values of the published algorithm, written out here again so that a slip in either place shows.
SPECIAL_STEMS = dict(
    zip(
        "skis skies dying lying tying idly gently ugly early only singly".split(),
        "ski sky die lie tie idl gentl ugli earli onli singl".split(),
    )
)
UNCHANGED = ["sky", "news", "howe", "atlas", "cosmos", "bias", "andes"]
UNCHANGED_AFTER_PLURAL = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]
STEP_2 = dict(
    pair.split(":")
    for pair in """tional:tion enci:ence anci:ance abli:able entli:ent izer:ize ization:ize ational:ate ation:ate
    ator:ate alism:al aliti:al alli:al fulness:ful ousli:ous ousness:ous iveness:ive iviti:ive biliti:ble bli:ble
    ogi:og fulli:ful lessli:less li:""".split()
)
STEP_3 = dict(
    pair.split(":")
    for pair in "tional:tion ational:ate alize:al icate:ic iciti:ic ical:ic ful: ness: ative:".split()
)
STEP_4 = "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion".split()
LETTERS_BEFORE = {"ogi": "l", "li": "cdeghkmnrt", "ion": "st"}

SHORT = "(^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$"
TO_REGION = "^.*?[aeiouy][^aeiouy]"


def _in(values) -> str:
    return "(" + ", ".join(f"'{value}'" for value in values) + ")"


def _cases(subject: str, table: dict[str, str]) -> str:
    return f"case {subject} " + " ".join(f"when '{k}' then '{v}'" for k, v in table.items()) + " end"


def _suffix_step(name: str, source: str, table: dict[str, str], second_region=()) -> str:
    """Longest suffix by the leftmost match, then the region and the letter in front of it."""
    letter = " ".join(
        f"when '{suffix}' then regexp_matches(base, '[{letters}]$')" for suffix, letters in LETTERS_BEFORE.items()
    )
    region = f"case when suffix in {_in(second_region)} then r2 else r1 end" if second_region else "r1"
    return f"""{name}_found as (
  select *, regexp_extract(s, '({"|".join(table)})$', 1) suffix from {source}),
{name}_split as (select *, left(s, length(s) - length(suffix)) base from {name}_found),
{name} as (
  select word, r1, r2, plural,
         case when suffix <> '' and length(base) >= {region} and case suffix {letter} else true end
              then base || {_cases('suffix', table)} else s end s
  from {name}_split)"""


def stem_ctes(words: str) -> str:
    """Table expressions that end in stems(word, stem), for the distinct words of `words`. Each is worked out once."""
    return _steps(words).replace(" as (\n", " as materialized (\n")


def _steps(words: str) -> str:
    return f"""marked as (
  select word,
         regexp_replace(regexp_replace(regexp_replace(translate(word, '‘’‛', ''''''''), '^''', ''), '^y', 'Y'),
                        '([aeiouy])y', '\\1Y', 'g') w
  from {words}
  where length(word) >= 3 and word not in {_in(UNCHANGED)}
    and word not in {_in(SPECIAL_STEMS)}),
region_1 as (
  select *, case when starts_with(w, 'gener') or starts_with(w, 'arsen') then 5 when starts_with(w, 'commun') then 6
                 else coalesce(nullif(length(regexp_extract(w, '{TO_REGION}')), 0), length(w)) end r1
  from marked),
regions as (
  select *, coalesce(r1 + nullif(length(regexp_extract(substr(w, r1 + 1), '{TO_REGION}')), 0), length(w)) r2
  from region_1),
bare as (select *, regexp_replace(w, '(''s''|''s|'')$', '') s from regions),
plurals as (
  select word, r1, r2,
         case when regexp_matches(s, 'sses$') then left(s, length(s) - 2)
              when regexp_matches(s, 'ie[ds]$') then left(s, length(s) - case when length(s) > 4 then 2 else 1 end)
              when regexp_matches(s, '(us|ss)$') then s
              when regexp_matches(s, '[aeiouy].+s$') then left(s, length(s) - 1)
              else s end s
  from bare),
past_found as (
  select *, s plural, regexp_extract(s, '(eedly|ingly|edly|eed|ing|ed)$', 1) suffix from plurals),
past_split as (select *, left(s, length(s) - length(suffix)) base from past_found),
past as (
  select word, r1, r2, plural,
         case when suffix in ('eed', 'eedly') then case when length(base) >= r1 then base || 'ee' else s end
              when suffix = '' or not regexp_matches(base, '[aeiouy]') then s
              when regexp_matches(base, '(at|bl|iz)$') then base || 'e'
              when regexp_matches(base, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') then left(base, length(base) - 1)
              when length(base) <= r1 and regexp_matches(base, '{SHORT}') then base || 'e'
              else base end s
  from past_split),
final_y as (
  select * replace (regexp_replace(s, '^(.+[^aeiouy])[yY]$', '\\1i') as s) from past),
{_suffix_step('second', 'final_y', STEP_2)},
{_suffix_step('third', 'second', STEP_3, ['ative'])},
{_suffix_step('fourth', 'third', dict.fromkeys(STEP_4, ''), STEP_4)},
fifth as (
  select *, case when regexp_matches(s, 'e$') and (length(s) > r2 or (length(s) > r1 and not regexp_matches(left(s, length(s) - 1), '{SHORT}')))
                 then left(s, length(s) - 1)
                 when regexp_matches(s, 'll$') and length(s) > r2 then left(s, length(s) - 1)
                 else s end t
  from fourth),
stems as (
  select words.word,
         coalesce({_cases('words.word', SPECIAL_STEMS)},
                  case when plural in {_in(UNCHANGED_AFTER_PLURAL)} then plural else translate(t, 'Y', 'y') end,
                  words.word) stem
  from {words} words left join fifth on words.word = fifth.word)"""
