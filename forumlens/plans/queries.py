"""Every query by name, over the given tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.functions.text import clean_words, is_stopword, split_words, strip_html, strip_punctuation
from forumlens.operators import features, hashed_terms as hashing, linear_model, metrics, relations, selection, splitting, stemming, terms
from forumlens.plans import analyses, answer_model, ledger, tag_model
from forumlens.plans.training import row_counts
from forumlens.session import scratch_path, stored
from forumlens.sources import forum_csv, question_store, schemas
from forumlens.sources import sample_tables as sample
from forumlens.sources.writers import write_result

Query = Callable[[SparkSession, str], DataFrame]

def _posts(spark: SparkSession, folder: str) -> DataFrame:
    return sample.posts(spark, folder).select("id", "creation_date", "score")


def _high_score(spark: SparkSession, folder: str) -> DataFrame:
    scored = selection.score_filter(_posts(spark, folder).select("id", "score"))
    return relations.with_tags(scored, sample.post_tags(spark, folder))


def _document_terms(spark: SparkSession, folder: str) -> DataFrame:
    words = split_words(strip_punctuation(F.lower("text")))
    return terms.term_counts(sample.documents(spark, folder), "doc_id", words)


def _predicted_quality(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion_matrix(
        sample.labels(spark, folder).select(
            F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction")
        )
    )


# Activity


def posts_per_year(spark, folder):
    return analyses.questions_per_year(_posts(spark, folder))


def posts_per_month(spark, folder):
    return analyses.questions_per_month(_posts(spark, folder))


def answered_per_month(spark, folder):
    return analyses.answered_questions_per_month(_posts(spark, folder), sample.replies(spark, folder))


# Tags


def tag_frequency(spark, folder):
    return analyses.tag_frequency(_posts(spark, folder), sample.post_tags(spark, folder))


def answered_tag_frequency(spark, folder):
    return analyses.answered_tag_frequency(
        _posts(spark, folder), sample.replies(spark, folder), sample.post_tags(spark, folder)
    )


def unanswered_tag_frequency(spark, folder):
    return analyses.unanswered_tag_frequency(
        _posts(spark, folder), sample.replies(spark, folder), sample.post_tags(spark, folder)
    )


def unanswered_top20_tags(spark, folder):
    return analyses.unanswered_tag_frequency(
        _posts(spark, folder), sample.replies(spark, folder), sample.post_tags(spark, folder), limit=20
    )


def top20_tags(spark, folder):
    return analyses.tag_frequency(_posts(spark, folder), sample.post_tags(spark, folder), limit=20)


def answered_top20_tags(spark, folder):
    return analyses.answered_tag_frequency(
        _posts(spark, folder), sample.replies(spark, folder), sample.post_tags(spark, folder), limit=20
    )


def top20_tag_scores(spark, folder):
    return analyses.tag_score_sum(_posts(spark, folder), sample.post_tags(spark, folder), limit=20)


def tag_score_sum(spark, folder):
    return analyses.tag_score_sum(_posts(spark, folder), sample.post_tags(spark, folder))


def answered_tag_count_histogram(spark, folder):
    return analyses.answered_tag_count_histogram(
        _posts(spark, folder), sample.replies(spark, folder), sample.post_tags(spark, folder)
    )


def unanswered_tag_count_histogram(spark, folder):
    return analyses.unanswered_tag_count_histogram(
        _posts(spark, folder), sample.replies(spark, folder), sample.post_tags(spark, folder)
    )


def post_score_tag_count(spark, folder):
    return analyses.question_score_tag_count(_posts(spark, folder), sample.post_tags(spark, folder))


def mean_tags_per_post(spark, folder):
    mean = analyses.mean_tags_per_question(_posts(spark, folder), sample.post_tags(spark, folder))
    return mean.select(F.round("mean_tags", 6).alias("mean_tags"))


def analysis_reports(spark, folder):
    """All reports of the joint run in one long table; the mean in millionths, the tag counts by question id."""
    tags = stored(sample.post_tags(spark, folder), "post-tags")
    return _long_table(analyses.analyse(_posts(spark, folder), sample.replies(spark, folder), tags))


def store_reports(spark, folder):
    """The same reports from a store laid out by question id, written here."""
    tags, path = sample.post_tags(spark, folder), scratch_path(spark, "store")
    store = question_store.write_store(_posts(spark, folder), sample.replies(spark, folder), tags, path)
    return _long_table(analyses.analyse_store(store))


def store_tag_scores(spark, folder):
    """Questions of the store with their label and each of their tags."""
    path = scratch_path(spark, "store")
    store = question_store.write_store(_posts(spark, folder), sample.replies(spark, folder), sample.post_tags(spark, folder), path)
    return store.tagged(store.labelled("score"))


def _long_table(reports: dict[str, DataFrame]) -> DataFrame:
    reports["question_score_tag_count"] = reports["question_score_tag_count"].select("id", "tag_count")
    mean = F.round(F.col("mean_tags") * 1000000).alias("mean_tags")
    reports["mean_tags_per_question"] = reports["mean_tags_per_question"].select(F.lit("millionths").alias("unit"), mean)
    result = None
    for name, df in reports.items():
        key, value = df.columns
        rows = df.select(
            F.lit(name).alias("report"), F.col(key).cast("string").alias("item"), F.col(value).cast("bigint").alias("value")
        )
        result = rows if result is None else result.unionByName(rows)
    return result


# Filters, joins and selection


def answered_posts(spark, folder):
    return relations.answered(_posts(spark, folder), sample.replies(spark, folder))


def unanswered_posts(spark, folder):
    return relations.unanswered(_posts(spark, folder), sample.replies(spark, folder))


def high_score_post_tags(spark, folder):
    return _high_score(spark, folder)


def top_tags(spark, folder):
    return selection.top_tags(_high_score(spark, folder))


def frequent_tags(spark, folder):
    """Tags that hold a twenty-fifth of the rows or more."""
    tagged = stored(_high_score(spark, folder), "high-score")
    return selection.frequent_tags(tagged, math.ceil(tagged.count() / 25))


def posts_with_top_tags(spark, folder):
    tagged = stored(_high_score(spark, folder), "high-score")
    return selection.keep_tags(tagged, selection.top_tags(tagged))


def label_answered(spark, folder):
    return relations.label_answered(_posts(spark, folder).select("id", "score"), sample.replies(spark, folder))


def answered_union_unanswered(spark, folder):
    return relations.answered_union_unanswered(
        _posts(spark, folder).select("id", "score"), sample.replies(spark, folder)
    )


def top_scored_k(spark, folder):
    """As many of the highest-scored posts as there are unanswered ones."""
    scored = _posts(spark, folder).select("id", "score")
    k = relations.unanswered(scored, sample.replies(spark, folder)).count()
    return selection.highest_scores(scored, k)


def balanced_posts(spark, folder):
    return answer_model.balanced_questions(_posts(spark, folder), sample.replies(spark, folder))


def balance_classes(spark, folder):
    rated = sample.labels(spark, folder).select("doc_id", "quality")
    return selection.balance_classes(rated, F.col("doc_id"), label="quality")


def hash_split(spark, folder):
    documents = sample.table(spark, folder, "documents")
    return documents.select("doc_id", splitting.is_train("doc_id").cast("int").alias("is_train"))


def hash_folds(spark, folder):
    documents = sample.table(spark, folder, "documents")
    return documents.select("doc_id", splitting.fold("doc_id", 5).alias("fold"))


# Text


def strip_html_pages(spark, folder):
    return sample.pages(spark, folder).select("page_id", strip_html(F.lower("body")).alias("body"))


def strip_punctuation_documents(spark, folder):
    return sample.documents(spark, folder).select("doc_id", strip_punctuation(F.col("text")).alias("text"))


def tokens(spark, folder):
    return _document_terms(spark, folder)


def title_and_body(spark, folder):
    return sample.pages(spark, folder).select(
        "page_id", F.concat_ws(" ", "title", strip_html(F.lower("body"))).alias("text")
    )


def remove_stopwords(spark, folder):
    return _document_terms(spark, folder).filter(~is_stopword(F.col("word")))


def cleaned_pages(spark, folder):
    """Title and body through all steps but the stemming."""
    questions = sample.pages(spark, folder).withColumnRenamed("page_id", "id")
    return features.clean_corpus(questions, stemmed=False).withColumnRenamed("id", "page_id")


def clean_corpus(spark, folder):
    questions = sample.pages(spark, folder).withColumnRenamed("page_id", "id")
    return features.clean_corpus(questions).withColumnRenamed("id", "page_id")


def repeated_ids_cleaned(spark, folder):
    """Pages under ids that each stand several times: every row keeps its own text."""
    questions = sample.pages(spark, folder).withColumn("id", F.col("page_id") % 7)
    return features.clean_corpus(questions)


def page_tag(spark, folder):
    return sample.pages(spark, folder).select("page_id", "tag")


def vocabulary(spark, folder):
    return terms.vocabulary(_document_terms(spark, folder))


def stem_vocabulary(spark, folder):
    words = sample.documents(spark, folder).select(clean_words(F.col("text"), html=True).alias("words"))
    return stemming.stem_vocabulary(stemming.count_words(words, "words"))


def idf(spark, folder):
    values = terms.inverse_document_frequency(
        _document_terms(spark, folder), sample.table(spark, folder, "documents")
    )
    return values.withColumn("idf", F.round("idf", 6))


def tf_idf(spark, folder):
    weights = terms.tf_idf(_document_terms(spark, folder), sample.table(spark, folder, "documents"), "doc_id")
    return weights.select("doc_id", "word", "n", F.round("tf_idf", 6).alias("tf_idf"))


# Hashed terms and the model as tables


def _document_words(spark: SparkSession, folder: str) -> DataFrame:
    words = split_words(strip_punctuation(F.lower("text")))
    return sample.documents(spark, folder).select("doc_id", words.alias("words"))


def hashed_terms(spark, folder):
    return hashing.hashed_terms(_document_words(spark, folder), "doc_id", F.col("words"))


def bucket_collisions(spark, folder):
    return hashing.bucket_collisions(stored(terms.vocabulary(_document_terms(spark, folder)), "vocabulary"))


def _language_model(spark: SparkSession, folder: str) -> tuple[linear_model.LinearModel, DataFrame, DataFrame]:
    """Mean hashed TF-IDF of each language as a linear model, with the terms (id, feature, value) and the labels (id, name)."""
    counted = stored(hashed_terms(spark, folder), "hashed")
    documents = sample.table(spark, folder, "documents")
    idf = terms.inverse_document_frequency(counted.withColumnRenamed("bucket", "word"), documents)
    idf = F.broadcast(idf.select(F.col("word").alias("bucket"), "idf"))  # as many rows as there are buckets
    value = (F.col("tf") * F.col("idf") / 100).alias("value")
    weighted = stored(counted.join(idf, "bucket").select(F.col("doc_id").alias("id"), F.col("bucket").alias("feature"), value), "weighted")
    labels = documents.select(F.col("doc_id").alias("id"), F.col("lang").alias("name"))
    model = linear_model.class_means(weighted, labels)
    return linear_model.LinearModel(stored(model.coefficients, "coefficients"), model.intercepts), weighted, labels


def model_coefficients(spark, folder):
    return _language_model(spark, folder)[0].coefficients.withColumn("coefficient", F.round("coefficient", 6))


def scored_probabilities(spark, folder):
    """Probability of each language for each document."""
    model, weighted, labels = _language_model(spark, folder)
    scored = linear_model.scored_classes(model, linear_model.probabilities(model, weighted, labels))
    return scored.select("id", F.col("name").alias("tag"), F.round("probability", 6).alias("probability"))


def ranked_tags(spark, folder):
    """The three most likely languages of each document."""
    model, weighted, labels = _language_model(spark, folder)
    ranked = linear_model.ranked_classes(model, linear_model.probabilities(model, weighted, labels))
    return ranked.select("id", "rank", F.col("name").alias("tag"), F.round("probability", 6).alias("probability"))


def _classed(model: linear_model.LinearModel, labels: DataFrame) -> DataFrame:
    return labels.join(F.broadcast(model.intercepts.select("name", "class")), "name").select("id", "class")


PENALTY = linear_model.Penalty(reg_param=0.1, elastic_net_param=0.3)


def model_loss(spark, folder):
    """The penalised loss at the language model's coefficients."""
    model, weighted, labels = _language_model(spark, folder)
    found = linear_model.penalised_loss(model, weighted, _classed(model, labels), PENALTY)
    return found.select("rows", *[F.round(c, 6).alias(c) for c in ("log_loss", "penalty", "loss")])


def model_gradient(spark, folder):
    """Gradient of the loss's smooth part there, and the distance from optimality, by coefficient."""
    model, weighted, labels = _language_model(spark, folder)
    found = linear_model.optimality_gaps(linear_model.loss_gradient(model, weighted, _classed(model, labels), PENALTY), PENALTY)
    return found.select("feature", "class", *[F.round(c, 6).alias(c) for c in ("coefficient", "gradient", "gap")])


# Metrics


def confusion_matrix(spark, folder):
    return _predicted_quality(spark, folder)


def class_report(spark, folder):
    return metrics.class_report(_predicted_quality(spark, folder))


def accuracy(spark, folder):
    return metrics.summary(_predicted_quality(spark, folder)).select(F.round("accuracy", 6).alias("accuracy"))


def weighted_f1(spark, folder):
    return metrics.summary(_predicted_quality(spark, folder)).select(F.round("weighted_f1", 6).alias("weighted_f1"))


def balanced_accuracy(spark, folder):
    return metrics.summary(_predicted_quality(spark, folder)).select(
        F.round("balanced_accuracy", 6).alias("balanced_accuracy")
    )


def area_under_roc(spark, folder):
    """How well a document's length tells its quality."""
    lengths = sample.table(spark, folder, "documents").select("doc_id", "n_chars")
    scored = sample.labels(spark, folder).select("doc_id", "quality").join(lengths, "doc_id")
    return metrics.area_under_roc(scored, "quality", "n_chars").select(F.round("area_under_roc", 6).alias("area_under_roc"))


# Sources and sinks


def _write_forum_csv(spark: SparkSession, questions: DataFrame) -> str:
    """`questions` in the CSV columns, through the CSV sink."""
    columns = [F.col(model).alias(name) for name, model in schemas.MODEL_NAMES.items() if model in questions.columns]
    return write_result(
        questions.select(*columns), scratch_path(spark, "csv"), "questions", file_format="csv", header=True
    )


def _page_csv(spark: SparkSession, folder: str) -> str:
    """Pages written as question CSV, with their line breaks and quotes."""
    questions = sample.pages(spark, folder).select(
        F.col("page_id").alias("id"),
        F.lit(None).cast("int").alias("owner_user_id"),
        F.lit("2008-08-31T23:57:07Z").alias("creation_date"),
        F.lit("NA").alias("closed_date"),
        F.length("body").alias("score"),
        "title",
        "body",
    )
    return _write_forum_csv(spark, questions)


def csv_round_trip(spark, folder):
    return forum_csv.load_table(spark, _page_csv(spark, folder), schemas.QUESTIONS).rows


def csv_split_scan(spark, folder):
    return forum_csv.load_table(spark, _page_csv(spark, folder), schemas.QUESTIONS, split_files=True).rows


def csv_to_parquet(spark, folder):
    """Orders written as question CSV, read back, and stored as Parquet."""
    questions = sample.posts(spark, folder).select(
        "id",
        "owner_user_id",
        F.concat(F.translate(F.col("creation_date").cast("string"), " ", "T"), F.lit("Z")).alias("creation_date"),
        F.lit("NA").alias("closed_date"),
        "score",
        F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("string").alias("body"),
    )
    csv = forum_csv.load_table(spark, _write_forum_csv(spark, questions), schemas.QUESTIONS)
    target = scratch_path(spark, "parquet")
    forum_csv.convert_to_parquet(csv, f"{target}/rows", f"{target}/rejects", spark.sparkContext.defaultParallelism, "id")
    return spark.read.parquet(f"{target}/rows").select("id", "owner_user_id", "creation_date", "score")


# Models


def _with_side(rows: DataFrame, label: str) -> DataFrame:
    return rows.select(
        "id", label, splitting.is_train("id").cast("int").alias("is_train"), F.array_join("words", " ").alias("text")
    )


def tag_training_set(spark, folder):
    """All steps of the tag job up to the features, with the side of the split."""
    rows = tag_model.training_rows(sample.document_questions(spark, folder), sample.document_tags(spark, folder))
    return _with_side(rows, "tag")


def answer_training_set(spark, folder):
    """All steps of the answer job up to the features, with the side of the split."""
    rows = answer_model.training_rows(
        sample.labelled_questions(spark, folder), sample.quality_answers(spark, folder)
    )
    return _with_side(rows, "label")


def _tag_model(spark: SparkSession, folder: str) -> tag_model.TagModel:
    return tag_model.train_tag_model(sample.document_questions(spark, folder), sample.document_tags(spark, folder))


def _answer_model(spark: SparkSession, folder: str) -> answer_model.AnswerModel:
    return answer_model.train_answer_model(
        sample.labelled_questions(spark, folder), sample.quality_answers(spark, folder)
    )


def _prepared_tags(spark: SparkSession, folder: str):
    return tag_model.prepare_tags(sample.document_questions(spark, folder), sample.document_tags(spark, folder))


def tag_label_index(spark, folder):
    """Numbers of the tags in training, the most frequent first."""
    labels = _prepared_tags(spark, folder).stages.stages[-1].labels  # as many as the model has classes
    return spark.createDataFrame(list(enumerate(labels)), "label int, tag string")


def model_row_counts(spark, folder):
    return row_counts(_prepared_tags(spark, folder))


def train_idf(spark, folder):
    """IDF of the stemmed words on the training side of the tag job."""
    rows = tag_model.training_rows(sample.document_questions(spark, folder), sample.document_tags(spark, folder))
    train = stored(rows.filter(splitting.is_train("id")).select("id", "words"), "train-words")
    values = terms.inverse_document_frequency(terms.term_counts(train, "id", F.col("words")), train)
    return values.withColumn("idf", F.round("idf", 6))


def tag_model_metrics(spark, folder):
    return _tag_model(spark, folder).metrics()


def top3_tags(spark, folder):
    return _tag_model(spark, folder).likely_tags(3)


def top3_tags_per_question(spark, folder):
    """Number of ranks of each held-out question."""
    return top3_tags(spark, folder).groupBy("id").agg(F.count("*").alias("ranks"))


def tag_cv_grid(spark, folder):
    """All grid points over five folds."""
    return _tag_model(spark, folder).cross_validate(tag_model.CLUSTER_SETTINGS).grid


def _length_fits(spark: SparkSession, folder: str) -> DataFrame:
    """A ledger of a small grid: how well a least length tells the quality of labelled documents, fold by fold."""
    documents = sample.table(spark, folder, "documents").select("doc_id", "n_chars")
    rated = sample.labels(spark, folder).select("doc_id", "quality").join(documents, "doc_id")
    limits = F.array(*[F.struct(F.lit(n).alias("point"), F.lit(limit).alias("least")) for n, limit in enumerate((500, 1000, 2000, 4000))])
    tried = rated.select("*", splitting.fold("doc_id", 5).alias("fold"), F.inline(limits))
    right = ((F.col("n_chars") >= F.col("least")).cast("int") == F.col("quality")).cast("double")
    return tried.groupBy("point", "least", "fold").agg(F.count("*").alias("rows"), F.avg(right).alias("metric"))


def fold_metrics(spark, folder):
    return _length_fits(spark, folder).withColumn("metric", F.round("metric", 6))


def ledger_means(spark, folder):
    means = ledger.grid_means(_length_fits(spark, folder), "point", "least", folds=5)
    return means.select("point", "least", "folds", F.round("avg_metric", 6).alias("avg_metric"), F.col("best").cast("int").alias("best"))


def answer_model_metrics(spark, folder):
    return _answer_model(spark, folder).metrics()


def answer_cv_grid(spark, folder):
    """All grid points over five folds: 240 fits."""
    return _answer_model(spark, folder).cross_validate(answer_model.SETTINGS, parallelism=8).grid


QUERIES: dict[str, Query] = {
    "posts_per_year": posts_per_year,
    "posts_per_month": posts_per_month,
    "answered_per_month": answered_per_month,
    "tag_frequency": tag_frequency,
    "answered_tag_frequency": answered_tag_frequency,
    "unanswered_tag_frequency": unanswered_tag_frequency,
    "unanswered_top20_tags": unanswered_top20_tags,
    "top20_tags": top20_tags,
    "answered_top20_tags": answered_top20_tags,
    "top20_tag_scores": top20_tag_scores,
    "tag_score_sum": tag_score_sum,
    "answered_tag_count_histogram": answered_tag_count_histogram,
    "unanswered_tag_count_histogram": unanswered_tag_count_histogram,
    "post_score_tag_count": post_score_tag_count,
    "mean_tags_per_post": mean_tags_per_post,
    "analysis_reports": analysis_reports,
    "store_reports": store_reports,
    "store_tag_scores": store_tag_scores,
    "answered_posts": answered_posts,
    "unanswered_posts": unanswered_posts,
    "high_score_post_tags": high_score_post_tags,
    "top_tags": top_tags,
    "frequent_tags": frequent_tags,
    "posts_with_top_tags": posts_with_top_tags,
    "label_answered": label_answered,
    "answered_union_unanswered": answered_union_unanswered,
    "top_scored_k": top_scored_k,
    "balanced_posts": balanced_posts,
    "balance_classes": balance_classes,
    "hash_split": hash_split,
    "hash_folds": hash_folds,
    "strip_html": strip_html_pages,
    "strip_punctuation": strip_punctuation_documents,
    "tokens": tokens,
    "title_and_body": title_and_body,
    "remove_stopwords": remove_stopwords,
    "cleaned_pages": cleaned_pages,
    "clean_corpus": clean_corpus,
    "repeated_ids_cleaned": repeated_ids_cleaned,
    "page_tag": page_tag,
    "vocabulary": vocabulary,
    "stem_vocabulary": stem_vocabulary,
    "idf": idf,
    "tf_idf": tf_idf,
    "hashed_terms": hashed_terms,
    "bucket_collisions": bucket_collisions,
    "model_coefficients": model_coefficients,
    "scored_probabilities": scored_probabilities,
    "ranked_tags": ranked_tags,
    "model_loss": model_loss,
    "model_gradient": model_gradient,
    "confusion_matrix": confusion_matrix,
    "class_report": class_report,
    "accuracy": accuracy,
    "weighted_f1": weighted_f1,
    "balanced_accuracy": balanced_accuracy,
    "csv_round_trip": csv_round_trip,
    "csv_split_scan": csv_split_scan,
    "csv_to_parquet": csv_to_parquet,
    "tag_training_set": tag_training_set,
    "answer_training_set": answer_training_set,
    "area_under_roc": area_under_roc,
    "tag_label_index": tag_label_index,
    "model_row_counts": model_row_counts,
    "train_idf": train_idf,
    "tag_model_metrics": tag_model_metrics,
    "top3_tags": top3_tags,
    "top3_tags_per_question": top3_tags_per_question,
    "tag_cv_grid": tag_cv_grid,
    "fold_metrics": fold_metrics,
    "ledger_means": ledger_means,
    "answer_model_metrics": answer_model_metrics,
    "answer_cv_grid": answer_cv_grid,
}
