"""Text and recommender jobs on the given texts and ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.adapters import Star
from tidemark.catalog.base import query
from tidemark.plans import biased, recommend, topics
from tidemark.session import cut


def _profile(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.size("tokens").cast("long").alias("n"), F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


@query("tokens")
def _(s: Star) -> DataFrame:
    return _profile(topics.tokenized(s.documents().select("doc_id", "text")))


def _grouped(s: Star) -> DataFrame:
    """Tokens of the labelled documents, computed once."""
    return cut(topics.tokenized(s.documents_by_quality()), "tokens")


def _all_tokens(s: Star) -> DataFrame:
    return cut(topics.tokenized(s.documents().select("doc_id", "text")), "tokens")


@query("phrases")
def _(s: Star) -> DataFrame:
    return topics.phrase_table(_all_tokens(s))


@query("phrase_tokens")
def _(s: Star) -> DataFrame:
    docs = _all_tokens(s)
    return _profile(topics.join_phrases(docs, topics.phrase_table(docs)))


@query("trigrams")
def _(s: Star) -> DataFrame:
    """Phrases found among the tokens after phrases have been joined once."""
    docs = _all_tokens(s)
    return topics.phrase_table(cut(topics.join_phrases(docs, topics.phrase_table(docs)), "bigrams"))


@query("lemmas")
def _(s: Star) -> DataFrame:
    """Plural forms replaced where the singular occurs among the words as well."""
    docs = _all_tokens(s)
    words = docs.select(F.explode("tokens").alias("w")).distinct()
    forms = words.filter(F.col("w").endswith("s")).select(F.col("w").alias("form"), F.expr("substring(w, 1, length(w) - 1)").alias("lemma"))
    known = forms.join(words.withColumnRenamed("w", "lemma"), "lemma", "left_semi")
    return _profile(topics.lemmatized(docs, known))


def _bags(s: Star, docs: DataFrame):
    """Dictionary over all groups, and the word counts written once for the iterations."""
    words = topics.dictionary(docs)
    return words, cut(words.transform(docs).drop("tokens"), "bags")


@query("document_terms")
def _(s: Star) -> DataFrame:
    """Dictionary terms with the number of documents they occur in, per group."""
    docs = _grouped(s)
    words = topics.dictionary(docs)
    each = docs.select("quality", F.explode(F.array_distinct("tokens")).alias("term"))
    counted = each.groupBy("quality", "term").agg(F.count("*").alias("documents"))
    return counted.join(topics.vocabulary(words).select("term"), "term", "left_semi")


def _topics(s: Star, docs: DataFrame, tfidf: bool) -> DataFrame:
    words, bags = _bags(s, docs)
    found = None
    for group in (1, 0):
        rows = bags.filter(F.col("quality") == group)
        column = "tfidf" if tfidf else "bow"
        rows = topics.with_tfidf(rows) if tfidf else rows
        terms = topics.topic_terms(topics.topic_model(rows, column), words).withColumn("quality", F.lit(group))
        found = terms if found is None else found.unionByName(terms)
    return found


@query("topic_terms")
def _(s: Star) -> DataFrame:
    return _topics(s, _grouped(s), tfidf=False)


@query("topic_terms_tfidf")
def _(s: Star) -> DataFrame:
    return _topics(s, _grouped(s), tfidf=True)


@query("term_weights")
def _(s: Star) -> DataFrame:
    """TF-IDF weight of every term in every document, per group, as the topic models take them."""
    words, bags = _bags(s, _grouped(s))
    groups = [topics.with_tfidf(bags.filter(F.col("quality") == g)) for g in (1, 0)]
    rows = topics.weights(groups[0].unionByName(groups[1]), "tfidf", words, ("doc_id", "quality"))
    return rows.withColumn("weight", F.round("weight", 9))


@query("phrase_topics")
def _(s: Star) -> DataFrame:
    docs = _grouped(s)
    return _topics(s, cut(topics.join_phrases(docs, topics.phrase_table(docs)), "phrases"), tfidf=True)


@query("document_topics")
def _(s: Star) -> DataFrame:
    docs = _grouped(s)
    _, bags = _bags(s, docs)
    both = [bags.filter(F.col("quality") == group) for group in (1, 0)]
    good, bad = (topics.best_topics(topics.topic_model(rows), rows) for rows in both)
    return good.withColumn("quality", F.lit(1)).unionByName(bad.withColumn("quality", F.lit(0)))


@query("topic_facts")
def _(s: Star) -> DataFrame:
    """What every fitted topic table has: topics, terms of each, and weights that fall and sum to at most one."""
    rows = _topics(s, _grouped(s), tfidf=False)
    each = rows.groupBy("quality", "topic").agg(
        F.count_distinct("term").alias("terms"), F.sum("weight").alias("total"), F.sort_array(F.collect_list(F.struct("position", "weight"))).alias("w")
    )
    falling = F.aggregate("w", F.struct(F.lit(True).alias("ok"), F.lit(1.0).alias("last")), lambda a, x: F.struct((a["ok"] & (x["weight"] <= a["last"])).alias("ok"), x["weight"].alias("last")))["ok"]
    return each.groupBy("quality").agg(
        F.count("*").alias("topics"), F.min("terms").alias("terms_each"), F.every(falling & (F.col("total") <= 1.0001)).alias("weights_fall")
    )


@query("recommender_facts")
def _(s: Star) -> DataFrame:
    """Every rated pair has one estimate on the scale, and every user its best five at most, in falling order."""
    _, found = recommend.cross_validate(cut(s.ratings(), "ratings"))
    on_scale = F.col("prediction").between(recommend.LOW, recommend.HIGH)
    users = recommend.top_n(found).groupBy("user_id").agg(F.count("*").alias("top"), F.min("prediction").alias("least"))
    pairs = found.groupBy("user_id").agg(F.count("*").alias("pairs"), F.every(on_scale).alias("on_scale"))
    return pairs.join(users, "user_id").select("user_id", "pairs", "on_scale", "top")


@query("rating_errors")
def _(s: Star) -> DataFrame:
    """Errors of the constant and of biases alone per fold, and whether the factors have an error on the scale. The given
    ratings are drawn without regard to user or product, so nothing can be far below the constant here."""
    fold = F.pmod(F.col("user_id") * 7 + F.col("product_id"), F.lit(3))
    rows = biased.errors(cut(s.ratings(), "ratings"), fold=fold)
    return rows.select("fold", "n", F.round("constant", 9).alias("constant"), F.round("biases", 9).alias("biases"), F.col("factors").between(0, recommend.HIGH - recommend.LOW).alias("fitted"))


@query("recommender_folds")
def _(s: Star) -> DataFrame:
    rmse, _ = recommend.cross_validate(cut(s.ratings(), "ratings"))
    return s.spark.sql("SELECT posexplode(:rmse) AS (fold, rmse)", args={"rmse": rmse})


@query("recommender_topn")
def _(s: Star) -> DataFrame:
    _, predictions = recommend.cross_validate(cut(s.ratings(), "ratings"))
    return recommend.top_n(predictions)
