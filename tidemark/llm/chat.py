"""Chat formatting by multi-party perspective rotation, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

CONTEXT_ROLES = ("system",)
TURNS_PER_PART = 512
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _plain(column: Column) -> Column:
    """Marker strings inside a text or name are broken by a space, so no turn can forge another."""
    return F.replace(F.replace(column, F.lit(OPEN), F.lit("<| im_start|>")), F.lit(CLOSE), F.lit("<| im_end|>"))


def rotate(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    context_roles: tuple[str, ...] = CONTEXT_ROLES, turns_per_part: int = TURNS_PER_PART,
) -> DataFrame:
    """Every dialogue as each of its participants sees it.

    One row per ``(conversation, perspective, part)``: ``rendered`` text, ``n_turns``, ``mask`` (array of
    ``start, end``: the character ranges to learn, end excluded) and ``n_learned`` characters. The perspective's own
    turns are headed ``assistant``, other speakers' ``user name=<speaker>``, turns of ``context_roles`` by their
    role. The ranges are contents and end markers of the perspective's own turns, never headers or others' words.

    The parts of a dialogue, in order, are its text: part ``p`` holds the turns numbered ``p * turns_per_part`` and
    up, so no row grows with its conversation, and a conversation of any share of all rows is dealt out by part.

    A null role is the participant ``unknown``, a null text is empty; both are rendered. Repeated rows count once;
    different rows of one turn follow each other by role and text. Turns without number come last, in the part -1.
    Rows without conversation form the dialogue whose id is null. A conversation of context turns alone has no
    participant and no row. Other columns are ignored.
    """
    rows = turns.select(
        F.col(conv_col).alias("_conv"), F.col(turn_col).alias("_turn"), F.coalesce(role_col, F.lit("unknown")).alias("_role"),
        F.coalesce(text_col, F.lit("")).alias("_text"),
    ).distinct().withColumn("_part", F.coalesce(F.floor(F.col("_turn") / turns_per_part), F.lit(-1)).cast("long"))
    speakers = (
        rows.where(~F.col("_role").isin(*context_roles)).select("_conv", F.col("_role").alias("_view")).distinct()
        .withColumnRenamed("_conv", "_of")
    )
    seen = rows.join(speakers, F.col("_conv").eqNullSafe(F.col("_of"))).drop("_of")
    own = F.col("_role") == F.col("_view")
    head = (
        F.when(own, F.lit("assistant")).when(F.col("_role").isin(*context_roles), F.col("_role"))
        .otherwise(F.concat(F.lit("user name="), _plain(F.col("_role"))))
    )
    start = F.concat(F.lit(OPEN), head, F.lit("\n"))
    body = F.concat(_plain(F.col("_text")), F.lit(CLOSE))
    order = [F.col("_turn").asc_nulls_last(), F.col("_role"), F.col("_text")]
    before = Window.partitionBy("_conv", "_view", "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    whole = F.concat(F.col("_start"), F.col("_body"), F.lit("\n"))
    placed = seen.withColumns({"_start": start, "_body": body}).withColumns({
        "_at": F.coalesce(F.sum(F.length(whole)).over(before), F.lit(0)), "_piece": whole, "_own": own,
    })
    span = F.struct((F.col("_at") + F.length("_start")).alias("start"), (F.col("_at") + F.length("_start") + F.length("_body")).alias("end"))
    packed = placed.groupBy("_conv", "_view", "_part").agg(
        F.sort_array(F.collect_list(F.struct("_at", "_piece"))).alias("_pieces"), F.count(F.lit(1)).alias("n_turns"),
        F.sort_array(F.collect_list(F.when(F.col("_own"), span))).alias("mask"),
        F.sum(F.when(F.col("_own"), F.length("_body")).otherwise(0)).alias("n_learned"),
    )
    return packed.select(
        F.col("_conv").alias(conv_col), F.col("_view").alias("perspective"), F.col("_part").alias("part"), "n_turns",
        F.array_join(F.col("_pieces._piece"), "").alias("rendered"), "mask", "n_learned",
    )


def digest(rendered: DataFrame) -> DataFrame:
    """The mask as text, as ``start-end,start-end``."""
    spans = F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string")))
    return rendered.withColumn("mask", F.array_join(spans, ","))


ORACLE = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
                  coalesce(CAST(floor(turn / 512) AS BIGINT), -1) AS part FROM conversations),
v AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
s AS (SELECT t.*, v.perspective, t.role = v.perspective AS own,
             '<|im_start|>' || CASE WHEN t.role = v.perspective THEN 'assistant' WHEN t.role = 'system' THEN 'system'
                 ELSE 'user name=' || replace(replace(t.role, '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>') END || chr(10) AS head,
             replace(replace(t.text, '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>') || '<|im_end|>' AS body
      FROM t JOIN v ON t.conv_id IS NOT DISTINCT FROM v.conv_id),
p AS (SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, part
                 ORDER BY turn NULLS LAST, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM s)
SELECT conv_id, perspective, part, count(*) AS n_turns, string_agg(head || body || chr(10), '' ORDER BY pos) AS rendered,
       coalesce(string_agg(CAST(CAST(pos + length(head) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(pos + length(head) + length(body) AS BIGINT) AS VARCHAR), ','
                ORDER BY pos) FILTER (WHERE own), '') AS mask,
       CAST(sum(CASE WHEN own THEN length(body) ELSE 0 END) AS BIGINT) AS n_learned
FROM p GROUP BY conv_id, perspective, part
"""
