"""Topic tables and reports (R1, R2, A10, U1, P1..P3, S10..S13).

The topic long form ``(method, topic_id, rank, term, weight)`` is the one
shape; the overview, the comparison and the wide doc-topic table derive from
it.  Groups here are per topic and hold at most ``n_top_terms`` rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_terms(df: DataFrame, n: int | None = None, topic_col: str = "topic_id",
               weight_col: str = "weight", term_col: str = "term") -> DataFrame:
    """1-based rank of terms in a topic by weight (ties: later term
    first), optionally only the top n (planned as a group-limited window)."""
    w = Window.partitionBy(topic_col).orderBy(F.col(weight_col).desc(), F.col(term_col).desc())
    out = df.withColumn("rank", F.row_number().over(w).cast("long"))
    return out.filter(F.col("rank") <= n) if n is not None else out


def topic_terms_long(ranked: DataFrame, method: str) -> DataFrame:
    """The long topic-term table."""
    return ranked.select(F.lit(method).alias("method"),
                         F.col("topic_id").cast("long").alias("topic_id"),
                         F.col("rank").cast("long").alias("rank"),
                         F.col("term").cast("string").alias("term"),
                         F.col("weight").cast("double").alias("weight"))


def topic_overview(terms_long: DataFrame, k: int = 10) -> DataFrame:
    """First k terms per topic joined by ', ', column top_{k}_terms,
    sorted by (method, topic_id)."""
    col = f"top_{k}_terms"
    top = terms_long.filter(F.col("rank") <= k)
    out = (top.groupBy("method", "topic_id")
           .agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("_t"))
           .select("method", "topic_id",
                   F.array_join(F.transform("_t", lambda x: x["term"]), ", ").alias(col)))
    return out.orderBy("method", "topic_id")


def topics_comparison(overviews: list[DataFrame | None]) -> DataFrame | None:
    """Union by column name of the overviews that exist; None if none."""
    frames = [o for o in overviews if o is not None]
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def doc_topic_wide(doc_topic: DataFrame, k: int, array_col: str = "topics") -> DataFrame:
    """``(doc_id, topic_00 .. topic_{k-1})`` from an array column."""
    return doc_topic.select(F.col("doc_id").cast("long").alias("doc_id"),
                            *[F.col(array_col)[i].cast("double").alias(f"topic_{i:02d}")
                              for i in range(k)])


def doc_topic_long(doc_topic: DataFrame, array_col: str = "topics") -> DataFrame:
    # posexplode_outer + null filter: a plain generator makes the optimizer
    # infer a size filter and push it, with the array expression inlined,
    # below the projections that materialize it (see vectorize.term_frequencies).
    return (doc_topic.select(F.col("doc_id").cast("long").alias("doc_id"),
                             F.posexplode_outer(array_col).alias("topic_id", "weight"))
            .filter(F.col("topic_id").isNotNull())
            .withColumn("topic_id", F.col("topic_id").cast("long")))


def topics_meta(doc_topic: DataFrame, method: str, k: int, path: str | None = None) -> DataFrame:
    """n_topics, n_docs, path (the stamp is added by the writer)."""
    return doc_topic.agg(F.count(F.lit(1)).alias("n_docs")).select(
        F.lit(method).alias("method"), F.lit(k).cast("long").alias("n_topics"),
        F.col("n_docs").cast("long").alias("n_docs"),
        F.lit(path).cast("string").alias("doc_topic_path"))


# --- P1 / P2: topics given as JSON in any of the accepted shapes -------------
def normalize_topics_json(df: DataFrame, json_col: str = "topics_json") -> DataFrame:
    """P2 + P1: a column holding a JSON list of topics in one of the accepted
    shapes -> ``(topic_id, rank, term, weight)``.

    Shapes: objects with terms/top_terms/words and topic_id/id (else the
    position); ``[id, [terms]]`` pairs; bare term lists (id = position).  A
    term is ``[term, weight]`` (weight parsed leniently, unparsable -> null)
    or a bare term (weight null).  The shape is decided by the first topic.
    """
    v = F.parse_json(F.col(json_col))
    first = F.try_variant_get(v, "$[0]", "variant")
    first_kind = F.schema_of_variant(first)
    is_obj = first_kind.startswith("OBJECT")
    # (id, terms) only when the first element is a number, or a text that is one: a bare topic with
    # exactly two [term, weight] pairs is then not mistaken for a pair.
    id_kind = F.schema_of_variant(F.try_variant_get(v, "$[0][0]", "variant"))
    is_pair = (first_kind.startswith("ARRAY")
               & (F.expr(f"array_size(try_variant_get(parse_json({json_col}), '$[0]', 'array<variant>'))") == 2)
               & ~id_kind.startswith("ARRAY")
               & (~id_kind.startswith("STRING")
                  | F.coalesce(F.try_variant_get(v, "$[0][0]", "string").rlike("^-?[0-9]+$"), F.lit(False)))
               & ~id_kind.startswith("OBJECT")
               & F.schema_of_variant(F.try_variant_get(v, "$[0][1]", "variant")).startswith("ARRAY"))
    shaped = df.select(F.col(json_col), v.alias("_v"), F.when(is_obj, "obj").when(is_pair, "pair")
                       .when(first_kind.startswith("ARRAY"), "list").alias("_shape"))
    topics = shaped.filter(F.col("_shape").isNotNull()).select(
        "_shape", F.posexplode_outer(F.expr("try_variant_get(_v, '$', 'array<variant>')"))
        .alias("_pos", "_t")).filter(F.col("_pos").isNotNull())
    t = F.col("_t")
    obj_terms = F.coalesce(F.try_variant_get(t, "$.terms", "array<variant>"),
                           F.try_variant_get(t, "$.top_terms", "array<variant>"),
                           F.try_variant_get(t, "$.words", "array<variant>"),
                           F.array().cast("array<variant>"))
    obj_id = F.coalesce(F.try_variant_get(t, "$.topic_id", "long"),
                        F.try_variant_get(t, "$.id", "long"), F.col("_pos").cast("long"))
    terms = (F.when(F.col("_shape") == "obj", obj_terms)
             .when(F.col("_shape") == "pair", F.try_variant_get(t, "$[1]", "array<variant>"))
             .otherwise(F.try_variant_get(t, "$", "array<variant>")))
    tid = (F.when(F.col("_shape") == "obj", obj_id)
           .when(F.col("_shape") == "pair", F.try_variant_get(t, "$[0]", "long"))
           .otherwise(F.col("_pos").cast("long")))
    per_topic = topics.select(tid.alias("topic_id"), terms.alias("_terms"))
    items = per_topic.select("topic_id", F.posexplode_outer("_terms").alias("_r", "_it")) \
                     .filter(F.col("_r").isNotNull())
    it = F.col("_it")
    is_pairish = (F.schema_of_variant(it).startswith("ARRAY")
                  & (F.expr("array_size(try_variant_get(_it, '$', 'array<variant>'))") >= 2))
    term = F.when(is_pairish, F.try_variant_get(it, "$[0]", "string")) \
            .otherwise(F.try_variant_get(it, "$", "string"))
    weight = F.when(is_pairish, F.try_variant_get(it, "$[1]", "double"))
    return items.select("topic_id", (F.col("_r") + 1).cast("long").alias("rank"),
                        term.alias("term"), weight.cast("double").alias("weight"))
