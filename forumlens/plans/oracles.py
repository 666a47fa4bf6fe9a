"""The same queries as SQL for another engine, over the given tables."""

from __future__ import annotations

from forumlens.functions.stopwords import ENGLISH_STOPWORDS
from forumlens.functions.text import PUNCTUATION
from forumlens.plans.model_sql import CERTIFIED, CLASS_MEANS, FEATURES, bucket_ctes
from forumlens.plans.stem_sql import stem_ctes


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


POSTS = """posts as (
  select o_orderkey id, o_custkey owner_user_id, o_orderdate creation_date,
         cast(cast(floor(o_totalprice / 10000) as integer) - 20 as integer) score
  from orders)"""
REPLIES = """replies as (
  select l_orderkey parent_id, l_shipdate creation_date, cast(floor(l_quantity) as integer) score
  from lineitem where l_returnflag = 'R')"""
POST_TAGS = """post_tags as (
  select distinct l_orderkey id, p_brand tag from lineitem join part on l_partkey = p_partkey)"""
FORUM = f"with {POSTS}, {REPLIES}, {POST_TAGS}"

ANSWERED = "(select * from posts semi join replies on posts.id = replies.parent_id)"
UNANSWERED = "(select * from posts anti join replies on posts.id = replies.parent_id)"
HIGH = "(select id, score, tag from posts join post_tags using (id) where score >= 10)"
TOP_TAGS = f"(select tag, count(*) as \"count\" from {HIGH} group by tag order by 2 desc, 1 limit 10)"

# RE2 spelling of the 29 whitespace characters.
WHITESPACE = (
    r"[\t-\r\x1c-\x20\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
PUNCT = _quoted(PUNCTUATION)
STOPWORDS = "(values " + ", ".join(f"({_quoted(word)})" for word in ENGLISH_STOPWORDS) + ")"
STOPWORD_LIST = "[" + ", ".join(map(_quoted, ENGLISH_STOPWORDS)) + "]"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{WHITESPACE}'), lambda w: w <> '')"


def _clean(text: str) -> str:
    return f"list_filter({_words(f'translate({text}, {PUNCT}, {_quoted("")})')}, lambda w: not list_contains({STOPWORD_LIST}, w))"


TERMS = f"""terms as (
  select doc_id, word, count(*) n
  from (select doc_id, unnest(regexp_split_to_array(translate(lower(text), {PUNCT}, ''), '{WHITESPACE}')) word
        from documents)
  where word <> '' group by 1, 2)"""
IDF = """idf as (
  select word, count(*) doc_count, ln(((select count(*) from documents) + 1.0) / (count(*) + 1.0)) idf
  from terms group by 1)"""
PAGES = """questions as (
  select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) title, html body,
         regexp_extract(html, '<html lang="([a-z]+)"', 1) tag
  from pages)"""
STRIPPED = "regexp_replace(lower(body), '<.*?>', '', 'g')"

PAGE_CSV = f"""with {PAGES}
select page_id id, cast(null as bigint) owner_user_id, timestamp '2008-08-31 23:57:07' creation_date,
       cast(null as timestamp) closed_date, cast(length(body) as integer) score, title, body
from questions"""

CONFUSION = """confusion as (
  select quality as label, 1 - toxic as prediction, count(*) n from labels group by 1, 2)"""
CLASSES = f"""with {CONFUSION}, classes as (select label as class from confusion union select prediction from confusion),
report as (
  select class,
         cast(coalesce((select sum(n) from confusion where label = class), 0) as bigint) support,
         cast(coalesce((select sum(n) from confusion where prediction = class), 0) as bigint) predicted,
         cast(coalesce((select sum(n) from confusion where label = class and prediction = class), 0) as bigint) correct
  from classes)"""


def _hash_number(first_digit: int, id_column: str = "doc_id") -> str:
    return f"cast(concat('0x', substr(md5(concat('100:', {id_column})), {first_digit}, 8)) as bigint)"


def _is_train(id_column: str) -> str:
    return f"cast({_hash_number(1, id_column)} % 100 < 70 as integer)"


TAG_ROWS = f"""chosen as (
  select doc_id id, lang tag, text body, {_is_train('doc_id')} is_train from documents
  where n_chars >= 10 and lang in (
    select lang from documents where n_chars >= 10 group by 1 order by count(*) desc, lang limit 10))"""


def _stemmed(source: str, id_column: str, words: str) -> str:
    """Table expressions that end in joined(id, text): the stems of each row's words in order."""
    return f"""cleaned as (select {id_column}, {words} words from {source}),
placed as materialized (select {id_column}, unnest(words) word, generate_subscripts(words, 1) place from cleaned),
vocabulary as materialized (select distinct word from placed),
{stem_ctes('vocabulary')},
joined as (
  select {id_column}, string_agg(stem, ' ' order by place) as text
  from placed join stems using (word) group by 1)"""


def _tag_counts(source: str) -> str:
    return f'select tag, count(*) as "count" from {source} join post_tags using (id) group by 1'


def _histogram(source: str) -> str:
    return f"""select tags_number, count(*) as "count"
from (select id, count(tag) tags_number from {source} join post_tags using (id) group by 1) group by 1"""


def _calendar(unit: str, source: str) -> str:
    return f'select cast({unit}(creation_date) as integer) creation_{unit}, count(*) as "count" from {source} group by 1'


REPORTS = {
    "questions_per_year": ("creation_year", "count", _calendar("year", "posts")),
    "questions_per_month": ("creation_month", "count", _calendar("month", "posts")),
    "answered_questions_per_month": ("creation_month", "count", _calendar("month", ANSWERED)),
    "tag_frequency": ("tag", "count", _tag_counts("posts")),
    "answered_tag_frequency": ("tag", "count", _tag_counts(ANSWERED)),
    "unanswered_tag_frequency": ("tag", "count", _tag_counts(UNANSWERED)),
    "tag_score_sum": (
        "tag",
        "score_sum",
        "select tag, cast(sum(score) as bigint) score_sum from posts join post_tags using (id) group by 1",
    ),
    "answered_tag_count_histogram": ("tags_number", "count", _histogram(ANSWERED)),
    "unanswered_tag_count_histogram": ("tags_number", "count", _histogram(UNANSWERED)),
}


def _report(name: str) -> str:
    return f"{FORUM} {REPORTS[name][2]}"


ORACLES: dict[str, str] = {
    "posts_per_year": _report("questions_per_year"),
    "posts_per_month": _report("questions_per_month"),
    "answered_per_month": _report("answered_questions_per_month"),
    "tag_frequency": _report("tag_frequency"),
    "answered_tag_frequency": _report("answered_tag_frequency"),
    "unanswered_tag_frequency": _report("unanswered_tag_frequency"),
    "unanswered_top20_tags": f"{_report('unanswered_tag_frequency')} order by 2 desc, 1 limit 20",
    "top20_tags": f"{_report('tag_frequency')} order by 2 desc, 1 limit 20",
    "answered_top20_tags": f"{_report('answered_tag_frequency')} order by 2 desc, 1 limit 20",
    "top20_tag_scores": f"{_report('tag_score_sum')} order by 2 desc, 1 limit 20",
    "tag_score_sum": _report("tag_score_sum"),
    "answered_tag_count_histogram": _report("answered_tag_count_histogram"),
    "unanswered_tag_count_histogram": _report("unanswered_tag_count_histogram"),
    "post_score_tag_count": f"""{FORUM}
select id, score, count(tag) tag_count from posts join post_tags using (id) group by 1, 2""",
    "mean_tags_per_post": f"""{FORUM}
select round(avg(n), 6) mean_tags
from (select id, count(tag) n from posts join post_tags using (id) group by 1)""",
    "analysis_reports": FORUM
    + " union all ".join(
        f""" select '{name}' report, cast({key} as varchar) item, cast("{value}" as bigint) as value from ({query})"""
        for name, (key, value, query) in REPORTS.items()
    )
    + """ union all select 'question_score_tag_count', cast(id as varchar), count(tag) from posts join post_tags using (id) group by id
 union all select 'mean_tags_per_question', 'millionths', cast(round(1000000 * avg(n)) as bigint)
 from (select count(tag) n from posts join post_tags using (id) group by id)""",
    "answered_posts": f"{FORUM} select id, creation_date, score from {ANSWERED}",
    "unanswered_posts": f"{FORUM} select id, creation_date, score from {UNANSWERED}",
    "high_score_post_tags": f"{FORUM} select * from {HIGH}",
    "top_tags": f"{FORUM} select * from {TOP_TAGS}",
    "frequent_tags": f"""{FORUM}
select tag, count(*) as "count" from {HIGH} group by tag having count(*) >= (select 0.04 * count(*) from {HIGH})""",
    "posts_with_top_tags": f"{FORUM} select * from {HIGH} where tag in (select tag from {TOP_TAGS})",
    "label_answered": f"""{FORUM}
select id, score, cast(case when parent_id is not null then 1 else 0 end as integer) as label
from posts left join (select distinct parent_id from replies) on id = parent_id""",
    "answered_union_unanswered": f"""{FORUM}
select id, score, cast(1 as integer) as label from {ANSWERED}
union all select id, score, cast(0 as integer) as label from {UNANSWERED}""",
    "top_scored_k": f"""{FORUM}
select id, score from posts order by score desc, id limit (select count(*) from {UNANSWERED})""",
    "balanced_posts": f"""{FORUM}, sizes as (
  select least((select count(*) from {ANSWERED}), (select count(*) from {UNANSWERED})) k)
(select id, cast(1 as integer) as label from {ANSWERED} order by score desc, id limit (select k from sizes))
union all
(select id, cast(0 as integer) as label from {UNANSWERED} order by score desc, id limit (select k from sizes))""",
    "balance_classes": """with numbered as (
  select doc_id, quality, row_number() over (partition by quality order by doc_id) rn from labels)
select doc_id, quality from numbered
where rn <= (select min(n) from (select count(*) n from labels group by quality))""",
    "hash_split": f"select doc_id, {_is_train('doc_id')} is_train from documents",
    "hash_folds": f"select doc_id, cast({_hash_number(9)} % 5 as integer) fold from documents",
    "strip_html": f"with {PAGES} select page_id, {STRIPPED} body from questions",
    "strip_punctuation": f"select doc_id, translate(text, {PUNCT}, '') as text from documents",
    "tokens": f"with {TERMS} select doc_id, word, n from terms",
    "title_and_body": f"with {PAGES} select page_id, concat_ws(' ', title, {STRIPPED}) as text from questions",
    "remove_stopwords": f"""with {TERMS}
select doc_id, word, n from terms anti join {STOPWORDS} stopwords(stopword) on word = stopword""",
    "cleaned_pages": f"""with {PAGES}
select page_id, array_to_string(list_concat({_clean('lower(title)')}, {_clean(STRIPPED)}), ' ') as text from questions""",
    "clean_corpus": f"""with {PAGES},
{_stemmed('questions', 'page_id', f"list_concat({_clean('lower(title)')}, {_clean(STRIPPED)})")}
select page_id, coalesce(text, '') as text from questions left join joined using (page_id)""",
    "stem_vocabulary": f"""with cleaned as (
  select unnest({_clean("regexp_replace(lower(text), '<.*?>', '', 'g')")}) word from documents),
vocabulary as materialized (select word, count(*) total_count from cleaned group by 1),
{stem_ctes('vocabulary')}
select word, total_count, stem from vocabulary join stems using (word)""",
    "tag_training_set": f"""with {TAG_ROWS},
{_stemmed('chosen', 'id', _clean(STRIPPED))}
select id, tag, is_train, coalesce(joined.text, '') as text from chosen left join joined using (id)""",
    "answer_training_set": f"""with rated as (
  select doc_id id, text body, n_chars score, cast(quality as integer) as label from documents join labels using (doc_id)),
numbered as (select *, row_number() over (partition by label order by score desc, id) place from rated),
chosen as (
  select * from numbered where place <= (select min(n) from (select count(*) n from rated group by label))),
{_stemmed('chosen', 'id', _clean(STRIPPED))}
select id, label, {_is_train('id')} is_train, coalesce(joined.text, '') as text from chosen left join joined using (id)""",
    "area_under_roc": """with counts as (
  select n_chars, sum(quality) ones, sum(1 - quality) zeros from documents join labels using (doc_id) group by 1),
placed as (select *, sum(zeros) over (order by n_chars) upto from counts)
select round(sum(ones * (upto - zeros / 2.0)) / (sum(ones) * sum(zeros)), 6) area_under_roc from placed""",
    "tag_label_index": f"""with {TAG_ROWS}
select cast(row_number() over (order by count(*) desc, tag) - 1 as integer) as label, tag from chosen where is_train = 1 group by tag""",
    "model_row_counts": f"""with {TAG_ROWS}, known as (select distinct tag from chosen where is_train = 1)
select count(*) filter (is_train = 1) train_rows,
       count(*) filter (is_train = 0 and known.tag is not null) test_rows,
       count(*) filter (is_train = 0 and known.tag is null) skipped_rows
from chosen left join known using (tag)""",
    "top3_tags_per_question": f"""with {TAG_ROWS}
select id, least(3, (select count(distinct tag) from chosen where is_train = 1)) ranks from chosen where is_train = 0 group by id""",
    "train_idf": f"""with {TAG_ROWS}, train as (select * from chosen where is_train = 1),
{_stemmed('train', 'id', _clean(STRIPPED))},
terms as (select distinct id, stem from placed join stems using (word))
select stem as word, count(*) doc_count, round(ln(((select count(*) from train) + 1.0) / (count(*) + 1.0)), 6) idf
from terms group by stem""",
    "page_tag": f"with {PAGES} select page_id, tag from questions",
    "vocabulary": f"""with {TERMS}
select word, cast(sum(n) as bigint) total_count, count(*) doc_count from terms group by 1""",
    "idf": f"with {TERMS}, {IDF} select word, doc_count, round(idf, 6) idf from idf",
    "tf_idf": f"with {TERMS}, {IDF} select doc_id, word, n, round(n * idf, 6) tf_idf from terms join idf using (word)",
    "confusion_matrix": f"with {CONFUSION} select * from confusion",
    "class_report": f"{CLASSES} select * from report",
    "accuracy": f"{CLASSES} select round(sum(correct) / sum(support), 6) accuracy from report",
    "weighted_f1": f"""{CLASSES}
select round(sum(support * 2.0 * correct / (support + predicted)) / sum(support), 6) weighted_f1 from report""",
    "balanced_accuracy": f"""{CLASSES}
select round(avg(correct / support), 6) balanced_accuracy from report where support > 0""",
    "csv_round_trip": PAGE_CSV,
    "csv_split_scan": PAGE_CSV,
    "csv_to_parquet": f"""with {POSTS}
select id, owner_user_id, creation_date, score from posts""",
}

ORACLES["store_reports"] = ORACLES["analysis_reports"]
ORACLES["store_tag_scores"] = f"""{FORUM}
select id, score, cast(id in (select parent_id from replies) as integer) as label, tag from posts join post_tags using (id)"""

HASHED = f"with {TERMS},\n{bucket_ctes('terms')}"
MODEL = f"{HASHED},\n{FEATURES},\n{CLASS_MEANS}"

ORACLES |= {
    "hashed_terms": f"{HASHED} select doc_id, bucket, cast(sum(n) as bigint) tf from terms join buckets using (word) group by 1, 2",
    "bucket_collisions": f"""{HASHED}
select bucket, count(*) words, cast(sum(n) as bigint) total_count, cast(max(n) as bigint) largest
from (select word, sum(n) n from terms group by 1) join buckets using (word) group by 1""",
    "model_coefficients": f"{MODEL} select feature, class, round(coefficient, 6) as coefficient from coefficients",
    "scored_probabilities": f"{MODEL} select id, tag, round(probability, 6) as probability from scored",
    "ranked_tags": f"""{MODEL}
select id, cast(place as integer) as rank, tag, round(probability, 6) as probability
from (select *, row_number() over (partition by id order by probability desc, class) place from scored) where place <= 3""",
    "model_loss": f"""{MODEL}, {CERTIFIED},
means as (select count(*) n, avg(ln(total) + most - margin) log_loss from scored s join labels_of l on s.id = l.id and s.tag = l.tag),
costs as (select sum(0.03 * abs(coefficient * scale) + 0.035 * (coefficient * scale) * (coefficient * scale)) penalty from coefficients join scales using (feature))
select n as "rows", round(log_loss, 6) as log_loss, round(penalty, 6) as penalty, round(log_loss + penalty, 6) as loss from means, costs""",
    "model_gradient": f"""{MODEL}, {CERTIFIED}
select feature, class, round(coefficient, 6) as coefficient, round(gradient, 6) as gradient,
       round(case when feature < 0 then abs(gradient) when coefficient = 0 then greatest(abs(gradient) - 0.03, 0) else abs(gradient + 0.03 * sign(coefficient)) end, 6) as gap
from gradient""",
}

LENGTH_FITS = f"""fits as (
  select point, least, cast({_hash_number(9)} % 5 as integer) fold, count(*) as "rows",
         avg(cast(cast(n_chars >= least as integer) = quality as integer)) metric
  from documents join labels using (doc_id), (values (0, 500), (1, 1000), (2, 2000), (3, 4000)) points(point, least) group by 1, 2, 3)"""

ORACLES |= {
    "repeated_ids_cleaned": f"""with {PAGES}, numbered as (select *, page_id % 7 id from questions),
{_stemmed('numbered', 'page_id', f"list_concat({_clean('lower(title)')}, {_clean(STRIPPED)})")}
select id, coalesce(text, '') as text from numbered left join joined using (page_id)""",
    "fold_metrics": f'with {LENGTH_FITS} select point, least, fold, "rows", round(metric, 6) as metric from fits',
    "ledger_means": f"""with {LENGTH_FITS},
means as (select point, least, count(distinct fold) folds, case when count(distinct fold) = 5 then avg(metric) end avg_metric from fits group by 1, 2)
select point, least, folds, round(avg_metric, 6) as avg_metric,
       cast(point = (select point from means where avg_metric is not null order by avg_metric desc, point limit 1) as integer) as best
from means""",
}
