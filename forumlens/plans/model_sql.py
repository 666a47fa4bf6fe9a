"""SQL for another engine: hashed terms, a linear model as tables, its loss and gradient."""

from __future__ import annotations

WORD = "4294967295::ubigint"


def _turned(x: str, by: int) -> str:
    return f"((({x}) << {by}) | (({x}) >> {32 - by})) & {WORD}"


def _mixed(blocks: str) -> str:
    """The published 32-bit hash's treatment of each block; its constants are fixed values."""
    first = f"list_transform({blocks}, lambda k: (k * 3432918353::ubigint) & {WORD})"
    return f"list_transform(list_transform({first}, lambda k: {_turned('k', 15)}), lambda k: (k * 461845907::ubigint) & {WORD})"


def bucket_ctes(terms: str, num_features: int = 1000) -> str:
    """Table expressions that end in buckets(word, bucket) for the words of `terms`."""
    pairs = lambda first, n: ", ".join(f"lpad(substr(digits, {first} + {2 * i}, 2), 2, '0')" for i in range(n - 1, -1, -1))
    block = f"cast(concat('0x', {pairs('8 * i + 1', 4)}) as ubigint)"
    tail = f"case when n % 4 > 0 then cast(concat('0x', {pairs('8 * (n // 4) + 1', 3)}) as ubigint) else 0::ubigint end"
    return f"""spelled as (select word, hex(encode(word)) digits, strlen(word) n from (select distinct word from {terms})),
cut as (select word, n, list_transform(range(n // 4), lambda i: {block}) blocks, [{tail}] tail from spelled),
mixed as (select word, n, {_mixed('blocks')} blocks, {_mixed('tail')} tail from cut),
reduced as (
  select word, xor(xor(list_reduce(blocks, lambda h, k: (({_turned('xor(h, k)', 13)}) * 5 + 3864292196::ubigint) & {WORD}, 42::ubigint), tail[1]), n::ubigint) h
  from mixed),
step1 as (select word, (xor(h, h >> 16) * 2246822507::ubigint) & {WORD} h from reduced),
step2 as (select word, (xor(h, h >> 13) * 3266489909::ubigint) & {WORD} h from step1),
step3 as (select word, xor(h, h >> 16)::bigint h from step2),
signed as (select word, case when h > 2147483647 then h - 4294967296 else h end h from step3),
buckets as (select word, cast(((h % {num_features}) + {num_features}) % {num_features} as integer) bucket from signed)"""


#: (id, feature, value): hashed TF-IDF of the documents; models and labels by language.
FEATURES = """hashed as (select doc_id, bucket, sum(n) tf from terms join buckets using (word) group by 1, 2),
bucket_idf as (
  select bucket, ln(((select count(*) from documents) + 1.0) / (count(*) + 1.0)) idf from hashed group by 1),
features as (select doc_id id, bucket feature, tf * idf / 100 as value from hashed join bucket_idf using (bucket)),
labels_of as (select doc_id id, lang as tag from documents)"""

CLASS_MEANS = """classes as (
  select tag, count(*) n, cast(row_number() over (order by tag) - 1 as integer) class,
         ln(count(*) / (select count(*) from documents)) intercept
  from labels_of group by 1),
coefficients as (
  select feature, class, sum(value) / any_value(n) coefficient
  from features join labels_of using (id) join classes using (tag) group by 1, 2),
margins as (
  select id, class, tag, intercept + coalesce(s, 0) margin
  from (select id, c.class, c.tag, c.intercept from labels_of l, classes c)
  left join (select id, class, sum(value * coefficient) s from features join coefficients using (feature) group by 1, 2) using (id, class)),
tops as (select id, max(margin) most from margins group by 1),
totals as (select id, any_value(most) most, sum(exp(margin - most)) total from margins join tops using (id) group by 1),
scored as (select id, class, tag, margin, most, total, exp(margin - most) / total probability from margins join totals using (id))"""

#: Of the elastic net with regParam 0.1 and elasticNetParam 0.3.
CERTIFIED = """scales as (
  select feature, sqrt(greatest(0, (sum(value * value) - sum(value) * sum(value) / (select count(*) from documents)) / ((select count(*) from documents) - 1))) scale
  from features group by 1),
rest as (select id, class, probability - cast(s.tag = l.tag as integer) r from scored s join labels_of l using (id)),
summed as (select feature, class, sum(value * r) / (select count(*) from documents) g from features join rest using (id) group by 1, 2),
gradient as (
  select feature, class, coalesce(coefficient, 0) coefficient, g / scale + 0.07 * coalesce(coefficient, 0) * scale gradient
  from summed join scales using (feature) left join coefficients using (feature, class) where scale > 0
  union all select -1, class, intercept, (select avg(r) from rest where rest.class = classes.class) from classes)"""
