"""Line deduplication by a log-template tree.

A line goes down a tree of fixed depth: by its number of tokens, then by its leading tokens. Tokens with a digit are
variable fields, ``<*>`` from the start, and never constants: lines of numbers have no template. In a leaf, a token that a tenth of the leaf's texts have at a
place is a constant of that place; other tokens are variable and generalised. What is left is the line's template. A
template whose share of constants is too small is none: for such lines, which belong to a smaller group in the leaf,
the share is halved until there is a template, or no token less common that is in ``MIN_DOCS`` texts at all. As shares
and not counts decide, a template stays whole however many texts have it. Lines of templates that recur across
documents are dropped, but for one: the first line of the first document stays, so that nothing vanishes from the
corpus.

Unlike a parser that meets lines one by one, the result does not depend on the order of rows, and no leaf is held
in one task: supports, templates and documents are counted by hash aggregation with partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import work_dir

MIN_DOCS = 2
DEPTH = 3
LEAF_PARTS = 10
CONSTANT_SHARE = 0.7
FREE_SHARE = 0.5
WILD = "<*>"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``session.cut`` with a codec, as the lines are the corpus once more; the shuffles behind what is written are
    given up at once, as nothing reads them again."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _masked(line: Column) -> Column:
    """Tokens with a digit masked, and single spaces between tokens; the few lines that need either are rewritten."""
    fields = F.when(line.rlike("[0-9]"), F.regexp_replace(line, r"(?<!\S)[^\s0-9]*+[0-9]\S*", WILD)).otherwise(line)
    return F.trim(F.when(fields.rlike(r"[\t\x0B\f\r]|  "), F.regexp_replace(fields, r"\s+", " ")).otherwise(fields))


def _lines(docs: DataFrame, id_col: str, text_col: str, depth: int) -> DataFrame:
    """``(_id, _sig, _no, _masked, _n, _leaf, _line)`` of every line that is not blank. ``_sig`` stands for the text,
    so that exact copies of a document count as one document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text, F.length(text)).alias("_sig"), F.posexplode(F.split(text, "\n")).alias("_no", "_raw"))
    # blank lines go before masking: a filter on the masked line would be computed twice
    rows = rows.where(F.col("_raw").rlike(r"\S")).select("_id", "_sig", "_no", _masked(F.col("_raw")).alias("_masked"))
    rows = rows.withColumn("_n", F.length("_masked") - F.length(F.replace("_masked", F.lit(" "), F.lit(""))) + 1)
    return rows.withColumns({
        "_leaf": F.xxhash64("_n", F.substring_index("_masked", " ", depth)), "_line": F.xxhash64("_masked", "_n"),
    })


def _in_documents(rows: DataFrame, keys: list[str], min_docs: int) -> DataFrame:
    """Keys that at least ``min_docs`` different texts have, and how many those are: ``_texts``."""
    once = rows.groupBy(*keys, "_sig").agg(F.lit(1).alias("_one"))
    return once.groupBy(*keys).agg(F.count(F.lit(1)).alias("_texts")).where(F.col("_texts") >= min_docs)


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, depth: int = DEPTH) -> DataFrame:
    """``(_id, _sig, _no, _template, _first)`` of the lines whose template at least ``min_docs`` different texts have;
    ``_first`` is the id and number of the template's first line."""
    rows = cut(_lines(docs, id_col, text_col, depth), "lines", "zstd")
    # counts go by hashes alone; the text of each kind of line is moved once
    leaves = _in_documents(rows.select("_leaf", "_sig"), ["_leaf"], min_docs)
    once = rows.groupBy("_leaf", "_line", "_sig").agg(F.lit(1).alias("_one"))
    counts = once.groupBy("_leaf", "_line").agg(F.count(F.lit(1)).alias("_docs")).join(leaves, "_leaf")
    kinds = rows.groupBy("_leaf", "_line").agg(F.min("_masked").alias("_masked"), F.min("_n").alias("_n"))
    known = cut(kinds.join(counts, ["_leaf", "_line"]), "line-kinds", "zstd")
    tokens = known.select("_leaf", "_line", "_n", "_docs", "_texts", F.posexplode(F.split("_masked", " ")).alias("_at", "_token")).where(F.col("_token") != WILD)
    tokens = tokens.withColumn("_token", F.xxhash64("_at", "_token"))
    support = tokens.groupBy("_leaf", "_token").agg(F.sum("_docs").alias("_support"), F.min("_texts").alias("_texts")).where(F.col("_support") >= min_docs)
    # how often the share of a tenth is halved until the token has it
    over = F.expr(f"(_texts - 1) div ({LEAF_PARTS} * _support)")
    constants = support.select("_leaf", "_token", F.when(over > 0, F.length(F.bin(over))).otherwise(0).alias("_step"))
    # the template is the set of constants with their places: an xor of hashes needs no list of them
    steps = (
        tokens.drop("_docs", "_texts").join(constants, ["_leaf", "_token"]).groupBy("_leaf", "_line", "_n", "_step")
        .agg(F.count(F.lit(1)).alias("_fixed"), F.bit_xor("_token").alias("_set"))
        .groupBy("_leaf", "_line", "_n").agg(F.array_sort(F.collect_list(F.struct("_step", "_fixed", "_set"))).alias("_steps"))
    )
    free = F.greatest(F.col("_n") - depth, F.lit(0))

    def solid(fixed: Column) -> Column:
        return (fixed >= F.col("_n") * CONSTANT_SHARE) & (fixed - F.least("_n", F.lit(depth)) >= free * FREE_SHARE)

    def state(fixed: Column, tokens: Column) -> Column:
        return F.struct(fixed.alias("_fixed"), tokens.alias("_set"))

    none = state(F.lit(0).cast("long"), F.lit(0).cast("long"))
    widest = F.aggregate("_steps", none, lambda a, x: F.when(solid(a["_fixed"]), a).otherwise(state(a["_fixed"] + x["_fixed"], a["_set"].bitwiseXOR(x["_set"]))))
    templates = steps.withColumn("_made", widest).where(solid(F.col("_made._fixed"))).select("_leaf", "_line", F.xxhash64("_leaf", "_n", "_made._set").alias("_template"))
    named = cut(rows.select("_id", "_sig", "_no", "_leaf", "_line").join(templates, ["_leaf", "_line"]).drop("_leaf", "_line"), "line-templates")
    first = named.groupBy("_template", "_sig").agg(F.min(F.struct("_id", "_no")).alias("_first"))
    shared = first.groupBy("_template").agg(F.count(F.lit(1)).alias("_texts"), F.min("_first").alias("_first"))
    return named.join(shared.where(F.col("_texts") >= min_docs).drop("_texts"), "_template")


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, depth: int = DEPTH) -> DataFrame:
    """The documents, all rows and columns, with the lines of recurring templates taken out of ``text_col``, and
    ``lines`` and ``lines_dropped`` added (columns of these names are replaced).

    Of each template the first line, by document id and line, stays. Lines end at line feeds; blank lines stay. A
    null text stays null and has no lines, an empty one has one. Rows without id count as documents but keep their
    text, as no other row can name their lines. Repeated rows are treated alike.
    """
    rows = recurring_lines(docs, id_col, text_col, min_docs, depth)
    gone = rows.where(F.struct("_id", "_no") != F.col("_first"))
    drops = gone.where(F.col("_id").isNotNull()).groupBy(F.col("_id").alias("__id"), F.col("_sig").alias("__sig")).agg(F.collect_set("_no").alias("__drop"))
    given = docs.columns
    text = F.coalesce(F.col(text_col), F.lit(""))
    signed = docs.withColumns({"__key": F.col(id_col), "__sign": F.xxhash64(text, F.length(text))})
    found = signed.join(drops, (F.col("__key") == F.col("__id")) & (F.col("__sign") == F.col("__sig")), "left")
    parts = F.split(F.col(text_col), "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__drop"))
    cleaned = F.when(F.col("__drop").isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n"))
    counts = {"lines": F.when(F.col(text_col).isNull(), 0).otherwise(F.size(parts)), "lines_dropped": F.coalesce(F.size("__drop"), F.lit(0))}
    others = [F.col(c) for c in given if c not in (text_col, *counts)]
    out = found.select(*others, cleaned.alias(text_col), *(v.alias(k) for k, v in counts.items()))
    return out.select(*[c for c in given if c not in counts], *counts)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: how many lines it has, how many go, whether any text is left, and the digest of what is left."""
    done = drop_recurring(docs, id_col, text_col)
    return done.select(id_col, "lines", "lines_dropped", (F.trim(F.coalesce(text_col, F.lit(""))) != "").alias("any_left"), F.sha2(F.coalesce(text_col, F.lit("")), 256).alias("text_sha256"))
