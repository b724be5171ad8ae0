"""Bag-of-words and TF-IDF (V1..V12, W1..W7).

The matrix has two forms.  *Sparse rows* ``(doc_id, ids, values)`` hold one
document each, ids ascending; models read them.  The *long* table ``(doc_id,
term_id, term, value)`` is made of them for sinks and statistics.

Plan shape:

* per document, in its own row: tokens, n-grams, term counts, the lookup in the
  vocabulary (``CountVectorizerModel``, a hash map in each task), idf and the
  norm; after the vocabulary nothing is shuffled;
* the vocabulary: a count-min sketch gives an upper bound for every term, so only
  terms that can be in the vocabulary reach the exact aggregate by term.  Texts
  are counted in blocks (``operators.text_counts``): no row for every term of
  every document is made or kept;
* a vocabulary that is too large to broadcast (no ``max_features``) is joined
  with the long counts instead, and its TF-IDF norm is a window by document.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import VectorizeConfig
from ..functions import text as T
from ..plans.joins import BROADCAST_MAX_BYTES, join_small, table_bytes
from ..session import stored
from . import text_counts as TC
from .partials import summed_partials

BOW_PATTERN = "bow"      # (?u)\b[a-z]{2,}\b
WORD_PATTERN = "word"    # (?u)\b\w\w+\b (TfidfVectorizer default)


def doc_terms(docs: DataFrame, text_col: str, cfg: VectorizeConfig,
              pattern: str = BOW_PATTERN, id_col: str = "doc_id") -> DataFrame:
    """V1/V2/V3 (+W5, W6, N19): ``(doc_id, terms array<string>)``."""
    toks = _tokens(pattern)(_read_text(text_col, cfg))
    lo, hi = cfg.ngram_range
    # Tokens are projected first: the n-gram lambdas then read a column
    # instead of re-running the tokenizer for every element.
    return (docs.select(F.col(id_col).alias("doc_id"), toks.alias("_toks"))
                .select("doc_id", T.ngrams("_toks", lo, hi).alias("terms")))


def _read_text(text_col: str, cfg: VectorizeConfig):
    """The text that a vectorizer reads."""
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return T.strip_accents(F.lower(t) if cfg.lowercase else t, cfg.strip_accents)


def _tokens(pattern: str):
    return T.bow_tokens if pattern == BOW_PATTERN else T.tfidf_tokens


def term_frequencies(terms: DataFrame, binary: bool = False) -> DataFrame:
    """V4/V5: ``(doc_id, term, tf)``, counted inside each document's row."""
    return long_counts(counted_rows(terms), binary)


def counted_rows(terms: DataFrame) -> DataFrame:
    """``(doc_id, _counts array<struct<term, tf>>)`` of ``(doc_id, terms)``."""
    return T.term_counts(terms, "terms").select("doc_id", "_counts")


def long_counts(counted: DataFrame, binary: bool = False) -> DataFrame:
    """``(doc_id, term, tf)`` of counted rows."""
    # inline_outer + null filter: a plain inline makes the optimizer infer a
    # size(array) > 0 filter and push it, with the whole array expression
    # inlined, below the projections that materialize it.
    out = counted.select("doc_id", F.inline_outer("_counts")).filter(F.col("term").isNotNull())
    if binary:
        out = out.withColumn("tf", F.lit(1).cast("long"))
    return out


def term_stats(tf: DataFrame) -> DataFrame:
    """V6 input: ``(term, df, ctf)`` over the corpus."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"),
                                  F.sum("tf").alias("ctf"))


@dataclass
class Vocabulary:
    """A fitted vocabulary: ``table`` is ``(term_id, term, df, ctf, idf)``,
    term_id in code-point order of the term (the column order)."""
    table: DataFrame
    n_docs: int
    size: int
    params: dict = field(default_factory=dict)
    #: Measured bytes of the table; asked for once if not given.
    n_bytes: int | None = None

    def measured(self) -> int:
        if self.n_bytes is None:
            self.n_bytes = table_bytes(self.table)
        return self.n_bytes

    def broadcastable(self) -> bool:
        return self.measured() <= BROADCAST_MAX_BYTES

    def with_table(self, table: DataFrame, n_docs: int | None = None) -> Vocabulary:
        """The same terms with other columns."""
        return Vocabulary(table, self.n_docs if n_docs is None else n_docs, self.size, self.params, self.n_bytes)


#: Cells of each of the sketch's hash rows; a cell sums the counts of the terms that fall on it.
SKETCH_CELLS, SKETCH_ROWS = 1 << 18, 2
#: Tasks of a pass that emits one partial result of fixed size a task.
PARTIAL_TASKS = 4096
#: Of the count that the sketch lets one guess for the last term of the vocabulary, the share that is tried first.
GUESSED_SHARE = 0.8
#: One document in so many names the candidates for the lower bound; they are counted over all documents.
CANDIDATE_SHARE = 16


def _cells(row: int):
    """The cell of a term's 64-bit hash in a hash row, numbered through all rows; each row takes bits of its own."""
    bits = SKETCH_CELLS.bit_length() - 1
    return (F.shiftrightunsigned(F.xxhash64("term"), bits * row).bitwiseAND(F.lit(SKETCH_CELLS - 1)) + SKETCH_CELLS * row).cast("int")


def sketch(tf: DataFrame) -> np.ndarray:
    """``df`` and ``ctf`` (columns) of all cells of the hash rows, as numbered by ``_cells``.

    A task adds its rows up in one matrix of fixed size; the matrices travel as bytes, and one reaches the driver.
    """
    bits, size = SKETCH_CELLS.bit_length() - 1, SKETCH_ROWS * SKETCH_CELLS

    def run(batches):
        df, ctf, read = np.zeros(size), np.zeros(size), 0  # exact up to 2**53
        for batch in batches:
            hashed = batch.column(0).to_numpy().view(np.uint64)
            counts = batch.column(1).to_numpy().astype(np.float64)
            read += len(counts)
            for row in range(SKETCH_ROWS):
                cell = (hashed >> np.uint64(bits * row) & np.uint64(SKETCH_CELLS - 1)).astype(np.int64) + SKETCH_CELLS * row
                np.add.at(df, cell, 1.0)
                np.add.at(ctf, cell, counts)
        return np.stack([df, ctf], axis=1), read

    # fewer map tasks make fewer partial sketches; narrow, nothing is moved
    hashed = tf.coalesce(PARTIAL_TASKS).select(F.xxhash64("term").alias("hash"), F.col("tf").cast("long").alias("tf"))
    return summed_partials(hashed, run, (size, 2))[0]


def _lowest_kept(tf: DataFrame, min_df: int, max_features: int, rank_by: str) -> int:
    """A count that the last term of the vocabulary reaches at least.

    Terms that lead in a share of the documents are counted exactly over all;
    the ``max_features``-th count among them is one that as many terms reach.
    """
    some = tf.filter(F.pmod(F.xxhash64("doc_id"), F.lit(CANDIDATE_SHARE)) == 0)
    leading = select_vocabulary(term_stats(some).checkpoint(eager=True), 1, 2 * max_features, rank_by)
    counted = term_stats(join_small(tf, leading.select("term"), "term", "left_semi"))
    enough = counted.filter(F.col("df") >= min_df).checkpoint(eager=True)
    return _cut_count(enough, rank_by, max_features)[0]


def prune_terms(tf: DataFrame, min_df: int, max_features: int | None, rank_by: str = "ctf") -> DataFrame:
    """The rows of ``tf`` whose term can be in the vocabulary.

    Each hash row of the sketch sums the counts of all terms of a cell, which
    is never less than the count of one of them.  A term of a cell below the
    lowest count that is kept cannot be kept, so the vocabulary of what is left
    is the vocabulary of all.
    """
    least = {"df": min_df, "ctf": min_df}  # df >= min_df makes ctf >= min_df
    if max_features is not None and max_features > 0:
        least[rank_by] = max(least[rank_by], _lowest_kept(tf, min_df, max_features, rank_by))
    if max(least.values()) <= 1:
        return tf
    sums = sketch(tf)
    alive = np.flatnonzero(np.logical_and.reduce([sums[:, c] >= least[k] for c, k in enumerate(("df", "ctf"))]))
    out = tf
    for r in range(SKETCH_ROWS):
        cells = alive[alive // SKETCH_CELLS == r].astype(np.int32)  # at most SKETCH_CELLS
        one = tf.sparkSession.createDataFrame(pa.table({"__cell": cells}))
        out = out.join(F.broadcast(one), _cells(r) == F.col("__cell"), "left_semi")
    return out


def select_vocabulary(stats: DataFrame, min_df: int = 1, max_features: int | None = None,
                      rank_by: str = "ctf") -> DataFrame:
    """V6/V7: df filter, then the top ``max_features`` by corpus count
    (ties: term ascending).  ``rank_by='df'`` is the binary-mode rule."""
    kept = stats.filter(F.col("df") >= F.lit(min_df))
    if max_features is None:
        return kept
    if max_features < 1:
        return kept.limit(0)
    lowest, left = _cut_count(kept, rank_by, max_features)
    # only the ties of the last count are put in order
    ties = kept.filter(F.col(rank_by) == F.lit(lowest)).orderBy("term").limit(left)
    return kept.filter(F.col(rank_by) > F.lit(lowest)).unionByName(ties)


def _cut_count(stats: DataFrame, rank_by: str, wanted: int) -> tuple[int, int]:
    """The count of the ``wanted``-th term in descending order (0 if there are
    fewer) and how many terms of that count are wanted: the power of two that
    holds it, then the counts inside.  Both tables combine map-side."""
    count = F.col(rank_by)
    octaves = stats.groupBy(F.floor(F.log2(count)).alias("octave")).agg(F.count(F.lit(1)).alias("n"))
    above = 0
    for octave, n in sorted(octaves.collect(), reverse=True):
        if above + n >= wanted:
            break
        above += n
    else:
        return 0, 0
    inside = (stats.filter(F.floor(F.log2(count)) == octave).groupBy(count.alias("c"))
              .agg(F.count(F.lit(1)).alias("n")))
    # at most ``wanted`` distinct counts are read, from the top
    for c, n in inside.orderBy(F.col("c").desc()).limit(wanted).collect():
        if above + n >= wanted:
            return int(c), wanted - above
        above += n
    return 0, 0


def index_vocabulary(vocab: DataFrame, bounded: bool) -> DataFrame:
    """V8: term_id = position in code-point order of the term.

    A capped vocabulary is small, so one ordered window is fine.  An uncapped
    one is dealt out by ranges of terms and numbered where it lies; a range's
    first number is the sum of the ranges before it (one row a range).
    """
    if bounded:
        w = Window.orderBy(F.col("term").asc())
        return vocab.withColumn("term_id", (F.row_number().over(w) - 1).cast("int"))
    # the generated id is the partition's number and, in its lower 33 bits, the row's place
    placed = (vocab.repartitionByRange("term").sortWithinPartitions("term")
              .withColumn("_at", F.monotonically_increasing_id()).checkpoint(eager=True))
    part = F.shiftright("_at", 33).alias("_range")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
              .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    return (placed.select("*", part).join(F.broadcast(starts), "_range")
            .withColumn("term_id", (F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).cast("int"))
            .drop("_at", "_range", "_start"))


#: Terms of a capped vocabulary up to which one ordered window numbers them.
MAX_WINDOW_TERMS = 1_000_000


def idf_expr(df_col, n_docs: int, use_idf: bool = True, smooth_idf: bool = True):
    """Smooth ln((1+n)/(1+df)) + 1, plain ln(n/df) + 1, or 1."""
    d = F.col(df_col).cast("double") if isinstance(df_col, str) else df_col
    if not use_idf:
        return F.lit(1.0)
    if smooth_idf:
        return F.log((F.lit(n_docs) + 1.0) / (d + 1.0)) + 1.0
    return F.log(F.lit(float(n_docs)) / d) + 1.0


def tf_weight_expr(tf_col="tf", sublinear: bool = True):
    """1 + ln(tf) (sublinear) or the raw count."""
    tf = (F.col(tf_col) if isinstance(tf_col, str) else tf_col).cast("double")
    return (F.log(tf) + 1.0) if sublinear else tf


def fit_vocabulary(tf: DataFrame, n_docs: int, cfg: VectorizeConfig) -> Vocabulary:
    """Fit V6..V8 (+ idf) and materialize the small vocabulary table.

    This is the only eager step (like a vectorizer ``fit``): the vocabulary is
    checkpointed, so later joins read a short lineage.
    """
    rank_by = "df" if cfg.binary else "ctf"
    stats = term_stats(prune_terms(tf, cfg.min_df, cfg.max_features, rank_by))
    if cfg.max_features is not None:  # read three times by the cut
        stats = stats.checkpoint(eager=True)
    return _fitted(stats, n_docs, cfg)


def _fitted(stats: DataFrame, n_docs: int, cfg: VectorizeConfig) -> Vocabulary:
    """V6..V8 (+ idf) of exact counts that hold every term of the vocabulary."""
    rank_by = "df" if cfg.binary else "ctf"
    vocab = select_vocabulary(stats, cfg.min_df, cfg.max_features, rank_by)
    vocab = index_vocabulary(vocab, cfg.max_features is not None and cfg.max_features <= MAX_WINDOW_TERMS)
    vocab = vocab.withColumn("idf", idf_expr("df", n_docs, cfg.use_idf, cfg.smooth_idf))
    vocab = vocab.select("term_id", "term", F.col("df").cast("long").alias("df"),
                         F.col("ctf").cast("long").alias("ctf"), "idf")
    vocab = vocab.checkpoint(eager=True)
    return Vocabulary(vocab, n_docs, vocab.count(), params=_params(cfg))


def fit_vocabulary_of_text(docs: DataFrame, text_col: str, n_docs: int, cfg: VectorizeConfig,
                           pattern: str = BOW_PATTERN, id_col: str = "doc_id") -> Vocabulary:
    """``fit_vocabulary`` of the terms of a text column, counted in blocks of texts.

    One pass makes the sketch, a second one counts the terms that reach a bound
    in it, exactly.  The bound is a guess from the sketch; it holds if as many
    terms as are wanted reach it by their exact counts.  If not, the exact count
    of the last of them is a bound that holds, and the second pass runs again.
    """
    lo, hi = cfg.ngram_range
    if not 1 <= lo <= hi <= 2:  # terms of more words are counted one by one
        return fit_vocabulary(stored(term_frequencies(doc_terms(docs, text_col, cfg, pattern, id_col), cfg.binary), "counts"), n_docs, cfg)
    rank_by = "df" if cfg.binary else "ctf"
    source = TC.token_source(docs, _read_text(text_col, cfg), _tokens(pattern), id_col).coalesce(PARTIAL_TASKS)
    least = {"df": max(1, cfg.min_df), "ctf": max(1, cfg.min_df)}  # df >= min_df makes ctf >= min_df
    wanted = cfg.max_features if cfg.max_features is not None and cfg.max_features > 0 else None
    if wanted is None and cfg.min_df <= 1:
        return _fitted(_text_stats(source, cfg, None), n_docs, cfg)
    sums = _text_sketch(source, cfg)
    lowest = least[rank_by]
    guess = lowest if wanted is None else max(lowest, _guessed_cut(sums[:, ("df", "ctf").index(rank_by)], wanted))
    while True:
        least[rank_by] = guess
        alive = np.logical_and.reduce([sums[:, c] >= least[k] for c, k in enumerate(("df", "ctf"))])
        stats = _text_stats(source, cfg, alive)
        if wanted is not None:  # read three times by the cut
            stats = stats.checkpoint(eager=True)
        if guess <= lowest:
            return _fitted(stats, n_docs, cfg)
        reached = _cut_count(stats.filter(F.col("df") >= cfg.min_df), rank_by, wanted)[0]
        if reached >= guess:
            return _fitted(stats, n_docs, cfg)
        guess = max(lowest, reached if reached else guess // 4)


def _text_sketch(source: DataFrame, cfg: VectorizeConfig) -> np.ndarray:
    """``sketch`` of texts (``text_counts.token_source``)."""
    bits, size = SKETCH_CELLS.bit_length() - 1, SKETCH_ROWS * SKETCH_CELLS
    (lo, hi), binary = cfg.ngram_range, cfg.binary

    def run(batches):
        out, read = np.zeros((2, size)), 0  # exact up to 2**53
        for block in TC.term_blocks(batches, lo, hi):
            hashed = TC.term_hashes(block)
            read += len(hashed)
            for row in range(SKETCH_ROWS):
                cell = (hashed >> np.uint64(bits * row) & np.uint64(SKETCH_CELLS - 1)).astype(np.int64)
                at = slice(SKETCH_CELLS * row, SKETCH_CELLS * (row + 1))
                df = np.bincount(cell, minlength=SKETCH_CELLS)
                out[0, at] += df
                out[1, at] += df if binary else np.bincount(cell, block.tf, SKETCH_CELLS)
        return out.T, read

    return summed_partials(source.select("plain", "tokens"), run, (size, 2))[0]


def _guessed_cut(cells: np.ndarray, wanted: int) -> int:
    """The count that the last of ``wanted`` terms may have: what its cell holds more than most cells do."""
    guesses = []
    for row in range(SKETCH_ROWS):
        one = cells[SKETCH_CELLS * row:SKETCH_CELLS * (row + 1)]
        nth = min(wanted, len(one))
        guesses.append(np.partition(one, len(one) - nth)[len(one) - nth] - np.median(one))
    return int(GUESSED_SHARE * min(guesses))


def _text_stats(source: DataFrame, cfg: VectorizeConfig, alive: np.ndarray | None) -> DataFrame:
    """``term_stats`` of the terms whose cells are ``alive`` in every hash row (of all terms, without)."""
    bits = SKETCH_CELLS.bit_length() - 1
    (lo, hi), binary = cfg.ngram_range, cfg.binary
    sent = source.sparkSession.sparkContext.broadcast(alive)

    def run(batches):
        for block in TC.term_blocks(batches, lo, hi):
            at = np.arange(len(block.a))
            if sent.value is not None:
                hashed = TC.term_hashes(block)
                for row in range(SKETCH_ROWS):
                    cell = (hashed[at] >> np.uint64(bits * row) & np.uint64(SKETCH_CELLS - 1)).astype(np.int64)
                    at = at[sent.value[SKETCH_CELLS * row + cell]]
            if not len(at):
                continue
            # the terms of all documents of the block, by their numbers
            order = at[np.argsort(block.a[at] * (len(block.words) + 1) + block.b[at])]
            a, b = block.a[order], block.b[order]
            starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            df = np.diff(np.r_[starts, len(order)])
            ctf = df if binary else np.add.reduceat(block.tf[order], starts)
            yield pa.RecordBatch.from_arrays([TC.term_strings(block, order[starts]), pa.array(df, pa.int64()), pa.array(ctf, pa.int64())],
                                             names=["term", "df", "ctf"])

    return (source.select("plain", "tokens").mapInArrow(run, "term string, df bigint, ctf bigint")
            .groupBy("term").agg(F.sum("df").alias("df"), F.sum("ctf").alias("ctf")))


def vocabulary_from_terms(spark, terms: list[str] | dict[str, int], n_docs: int = 0) -> Vocabulary:
    """V9: a fixed vocabulary given by the user (no fitting): a list of terms in
    column order, or a dict of term to column."""
    if isinstance(terms, dict):
        rows = sorted((int(i), t) for t, i in terms.items())
        if [i for i, _ in rows] != list(range(len(rows))):
            raise ValueError("vocabulary columns must be 0 to n-1, each once")
    else:
        rows = list(enumerate(terms))
    uniq = {t for _, t in rows}
    if len(uniq) < len(rows):
        raise ValueError("a vocabulary term is listed twice")
    table = spark.createDataFrame(rows, "term_id int, term string") \
        .withColumn("df", F.lit(None).cast("long")) \
        .withColumn("ctf", F.lit(None).cast("long")) \
        .withColumn("idf", F.lit(None).cast("double"))
    return Vocabulary(table, n_docs, len(uniq), params={"vocabulary": "fixed"})


#: Parameters that only the TF-IDF vectorizer has.
TFIDF_PARAMS = ("norm", "smooth_idf", "sublinear_tf", "use_idf")


def _params(cfg: VectorizeConfig) -> dict:
    return {k: getattr(cfg, k) for k in TFIDF_PARAMS} | {
        "max_features": cfg.max_features, "ngram_range": list(cfg.ngram_range),
        "min_df": cfg.min_df, "max_df": 1.0, "binary": cfg.binary,
        "lowercase": cfg.lowercase, "strip_accents": cfg.strip_accents,
    }


def _join_vocab(tf: DataFrame, vocab: Vocabulary, cols) -> DataFrame:
    side = vocab.table.select("term", *cols)
    return join_small(tf, side, on="term", how="inner", known_bytes=vocab.measured())


def bow_matrix(tf: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Long BoW matrix ``(doc_id, term_id, term, value)``; terms
    outside the vocabulary are ignored."""
    m = _join_vocab(tf, vocab, ["term_id"])
    return m.select("doc_id", "term_id", "term", F.col("tf").cast("double").alias("value"))


def count_rows(terms: DataFrame, vocab: Vocabulary, binary: bool = False) -> DataFrame:
    """V12/V9 as sparse rows ``(doc_id, ids, values)`` of counts.

    ``terms`` is ``(doc_id, terms)``.  A hash map of the vocabulary, which must
    be small enough to broadcast, looks the terms up in their row.
    """
    known = _known_terms(vocab)
    if not known:
        return terms.select("doc_id", F.array().cast("array<int>").alias("ids"), F.array().cast("array<double>").alias("values"))
    model = CountVectorizerModel.from_vocabulary(known, inputCol="terms", outputCol="features", binary=binary)
    return (model.transform(terms).select("doc_id", F.unwrap_udt("features").alias("v"))
            .select("doc_id", F.col("v.indices").alias("ids"), F.col("v.values").alias("values")))


def text_rows(docs: DataFrame, text_col: str, vocab: Vocabulary, cfg: VectorizeConfig, pattern: str = BOW_PATTERN,
              id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """``count_rows`` of a text column, counted in blocks of texts; the columns to ``keep`` go along."""
    lo, hi = cfg.ngram_range
    if not 1 <= lo <= hi <= 2:
        return count_rows(doc_terms(docs, text_col, cfg, pattern, F.struct(id_col, *keep) if keep else id_col), vocab, cfg.binary).select(
            *([F.col("doc_id")[c].alias("doc_id" if c == id_col else c) for c in (id_col, *keep)] if keep else ["doc_id"]), "ids", "values")
    source = TC.token_source(docs, _read_text(text_col, cfg), _tokens(pattern), id_col, keep)
    sent = source.sparkSession.sparkContext.broadcast(TC.term_index(_known_terms(vocab), lo, hi))
    binary, names = cfg.binary, ["doc_id", *keep]

    def run(batches):
        for part, of, word, words in TC.token_blocks(batches):
            doc, column, tf = TC.indexed_terms(sent.value, of, word, words)
            ends = pa.array(np.searchsorted(doc, np.arange(len(part) + 1)).astype(np.int32))
            values = np.ones(len(tf)) if binary else tf.astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in names), pa.ListArray.from_arrays(ends, pa.array(column.astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(values))], names=[*names, "ids", "values"])

    kinds = dict(source.dtypes)
    return source.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", ids array<int>, values array<double>")


def weighted_rows(rows: DataFrame, vocab: Vocabulary, cfg: VectorizeConfig, idf_col: str = "idf") -> DataFrame:
    """W1..W4 of sparse rows of counts: idf and norm inside each document's row; other columns stay."""
    if cfg.norm not in ("l1", "l2", None):
        raise ValueError(f"norm must be 'l1', 'l2' or None, got {cfg.norm!r}")
    if not vocab.broadcastable():
        raise ValueError(f"a vocabulary of {vocab.size} terms cannot be held by every task; set max_features")
    idf = vocab.table.orderBy("term_id").select(idf_col).toPandas()[idf_col].to_numpy(dtype=float)
    sent = rows.sparkSession.sparkContext.broadcast(idf)
    norm, sublinear = cfg.norm, cfg.sublinear_tf
    columns, kinds = [c for c in rows.columns if c not in ("ids", "values")], dict(rows.dtypes)

    def run(batches):
        for batch in batches:
            ids, counts = batch.column("ids"), batch.column("values").flatten().to_numpy()
            sizes = np.asarray(pc.list_value_length(ids))
            weights = (1.0 + np.log(counts) if sublinear else counts) * sent.value[ids.flatten().to_numpy()]
            if norm is not None and len(weights):
                own = np.repeat(np.arange(len(sizes)), sizes)
                total = np.bincount(own, weights * weights if norm == "l2" else np.abs(weights), len(sizes))
                total = np.sqrt(total) if norm == "l2" else total
                weights = np.divide(weights, total[own], out=np.zeros_like(weights), where=total[own] > 0)
            ends = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.ListArray.from_arrays(ends, ids.flatten()),
                                              pa.ListArray.from_arrays(ends, pa.array(weights))], names=batch.schema.names)

    return rows.select(*columns, "ids", "values").mapInArrow(
        run, ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", ids array<int>, values array<double>")


def summed_terms(rows: DataFrame, by: str, n_terms: int) -> DataFrame:
    """``(by, term_id, weight)``: the values of sparse rows summed by a column and term.

    Rows are added up a batch at a time, so a term is a row of a batch, not of a document.
    """
    def run(batches):
        for batch in batches:
            coded = batch.column(0).dictionary_encode(null_encoding="encode")
            group = coded.indices.to_numpy().astype(np.int64)
            sizes = np.asarray(pc.list_value_length(batch.column(1)))
            keys, at = np.unique(np.repeat(group, sizes) * n_terms + batch.column(1).flatten().to_numpy(), return_inverse=True)
            sums = np.bincount(at, batch.column(2).flatten().to_numpy(), len(keys))
            yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(keys // n_terms)), pa.array((keys % n_terms).astype(np.int32)),
                                              pa.array(sums)], names=[by, "term_id", "weight"])

    kind = dict(rows.dtypes)[by]
    return (rows.select(by, "ids", "values").mapInArrow(run, f"`{by}` {kind}, term_id int, weight double")
            .groupBy(by, "term_id").agg(F.sum("weight").alias("weight")))


def _known_terms(vocab: Vocabulary) -> list[str]:
    """The vocabulary's terms in column order; refused if it is too large for the driver and for every task."""
    if not vocab.broadcastable():
        raise ValueError(f"a vocabulary of {vocab.size} terms cannot be held by every task; set max_features")
    return vocab.table.orderBy("term_id").select("term").toPandas()["term"].tolist()


def tfidf_rows(terms: DataFrame, vocab: Vocabulary, cfg: VectorizeConfig, idf_col: str = "idf") -> DataFrame:
    """W1..W4 as sparse rows ``(doc_id, ids, values)``: counts, idf and norm inside each document's row."""
    known = _known_terms(vocab)
    if not known:
        return count_rows(terms, vocab)
    idf = vocab.table.orderBy("term_id").select(idf_col).toPandas()[idf_col].to_numpy(dtype=float)
    model = CountVectorizerModel.from_vocabulary(known, inputCol="terms", outputCol="features")
    scale = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="features", outputCol="scaled")
    rows = (scale.transform(model.transform(terms).select("doc_id", "features"))
            .select("doc_id", F.unwrap_udt("features").alias("f"), F.unwrap_udt("scaled").alias("s"))
            .select("doc_id", F.col("f.indices").alias("ids"), F.col("f.values").alias("tf"), F.col("s.values").alias("x")))
    if cfg.sublinear_tf:
        # x is tf * idf
        rows = rows.withColumn("x", F.zip_with("tf", "x", lambda tf, x: tf_weight_expr(tf) / tf * x))
    return rows.select("doc_id", "ids", norm_expr("x", cfg.norm).alias("n"), "x").select(
        "doc_id", "ids", (F.col("x") if cfg.norm is None else F.transform(
            "x", lambda x: F.when(F.col("n") > 0, x / F.col("n")).otherwise(0.0))).alias("values"))


def norm_expr(values: str, norm: str | None):
    """The l2 or l1 norm of an array column."""
    if norm == "l2":
        return F.sqrt(F.aggregate(values, F.lit(0.0), lambda a, x: a + x * x))
    if norm == "l1":
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + F.abs(x))
    if norm is not None:
        raise ValueError(f"norm must be 'l1', 'l2' or None, got {norm!r}")
    return F.lit(1.0)


def long_matrix(rows: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Sparse rows as the long table ``(doc_id, term_id, term, value)``."""
    entries = rows.select("doc_id", F.inline_outer(F.arrays_zip(F.col("ids").alias("term_id"), F.col("values").alias("value"))))
    names = vocab.table.select("term_id", "term")
    return (join_small(entries.filter(F.col("term_id").isNotNull()), names, "term_id", known_bytes=vocab.measured())
            .select("doc_id", "term_id", "term", "value"))


def tfidf_matrix(tf: DataFrame, vocab: Vocabulary, cfg: VectorizeConfig,
                 idf_col: str = "idf") -> DataFrame:
    """W1..W4: long TF-IDF matrix of long counts, for a vocabulary of any size.

    The join with the vocabulary is broadcast only within its size; the l1/l2
    norm is one window keyed by document.  ``tfidf_rows`` needs neither.
    """
    m = _join_vocab(tf, vocab, ["term_id", idf_col])
    w = tf_weight_expr("tf", cfg.sublinear_tf) * F.col(idf_col)
    m = m.select("doc_id", "term_id", "term", w.alias("value"))
    return normalize_rows(m, cfg.norm)


def normalize_rows(m: DataFrame, norm: str | None, value: str = "value") -> DataFrame:
    """l2 / l1 row normalization; all-zero rows stay zero."""
    if norm is None:
        return m
    by_doc = Window.partitionBy("doc_id")
    if norm == "l2":
        denom = F.sqrt(F.sum(F.col(value) * F.col(value)).over(by_doc))
    elif norm == "l1":
        denom = F.sum(F.abs(F.col(value))).over(by_doc)
    else:
        raise ValueError(f"norm must be 'l1', 'l2' or None, got {norm!r}")
    return m.withColumn(value, F.coalesce(F.try_divide(F.col(value), denom), F.lit(0.0)))


@dataclass
class Vectorized:
    """Result of a vectorizer: the long matrix, its vocabulary and n_docs; ``rows`` are the sparse rows that the
    matrix is made of (none if the vocabulary is too large to broadcast)."""
    matrix: DataFrame
    vocab: Vocabulary
    method: str
    vectorizer_type: str
    rows: DataFrame | None = None

    @property
    def n_docs(self) -> int:
        return self.vocab.n_docs


def vectorize_counts(terms: DataFrame, vocab: Vocabulary, binary: bool = False) -> Vectorized:
    """BoW of ``(doc_id, terms)`` over a vocabulary: sparse rows and their long form."""
    if not vocab.broadcastable():
        return Vectorized(bow_matrix(term_frequencies(terms, binary), vocab), vocab, "bow", "CountVectorizer")
    rows = count_rows(terms, vocab, binary)
    return Vectorized(long_matrix(rows, vocab), vocab, "bow", "CountVectorizer", rows)


def vectorize_weights(terms: DataFrame, vocab: Vocabulary, cfg: VectorizeConfig) -> Vectorized:
    """TF-IDF of ``(doc_id, terms)`` over a vocabulary with idf: sparse rows and their long form."""
    if not vocab.broadcastable():
        return Vectorized(tfidf_matrix(term_frequencies(terms), vocab, cfg), vocab, "tfidf", "TfidfVectorizer")
    rows = tfidf_rows(terms, vocab, cfg)
    return Vectorized(long_matrix(rows, vocab), vocab, "tfidf", "TfidfVectorizer", rows)


def vectorize_rows(rows: DataFrame, vocab: Vocabulary, cfg: VectorizeConfig | None = None) -> Vectorized:
    """BoW of stored sparse rows of counts (``text_rows``), or with ``cfg`` TF-IDF, and their long form."""
    if cfg is None:
        return Vectorized(long_matrix(rows, vocab), vocab, "bow", "CountVectorizer", rows)
    rows = weighted_rows(rows, vocab, cfg)
    return Vectorized(long_matrix(rows, vocab), vocab, "tfidf", "TfidfVectorizer", rows)


def vectorize_with_bow(docs: DataFrame, text_col: str, cfg: VectorizeConfig = VectorizeConfig(),
                       vocabulary: Vocabulary | None = None, id_col: str = "doc_id",
                       n_docs: int | None = None) -> Vectorized:
    """BoW with the BoW token pattern."""
    terms = doc_terms(docs, text_col, cfg, BOW_PATTERN, id_col)
    if vocabulary is None:
        n = docs.count() if n_docs is None else n_docs
        vocabulary = fit_vocabulary_of_text(docs, text_col, n, cfg, BOW_PATTERN, id_col)
    return vectorize_counts(terms, vocabulary, cfg.binary)


def vectorize_with_tfidf(docs: DataFrame, text_col: str,
                         cfg: VectorizeConfig = VectorizeConfig(),
                         vocabulary: Vocabulary | None = None, id_col: str = "doc_id",
                         n_docs: int | None = None) -> Vectorized:
    """TF-IDF with the default word pattern.

    With a given vocabulary (V10) the idf is refitted on the given documents
    unless the vocabulary carries stored idf values.
    """
    from dataclasses import replace
    cfg = replace(cfg, binary=False)
    terms = doc_terms(docs, text_col, cfg, WORD_PATTERN, id_col)
    if vocabulary is None:
        n = docs.count() if n_docs is None else n_docs
        vocabulary = fit_vocabulary_of_text(docs, text_col, n, cfg, WORD_PATTERN, id_col)
    elif vocabulary.table.filter(F.col("idf").isNull()).limit(1).count() > 0:
        vocabulary = refit_idf(term_frequencies(terms), vocabulary, docs.count() if n_docs is None else n_docs, cfg)
    return vectorize_weights(terms, vocabulary, cfg)


def refit_idf(tf: DataFrame, vocab: Vocabulary, n_docs: int, cfg: VectorizeConfig) -> Vocabulary:
    """Df and idf of a fixed vocabulary measured on the given documents."""
    known = join_small(tf.select("term"), vocab.table.select("term"), "term",
                       how="left_semi", known_bytes=vocab.measured())
    df = known.groupBy("term").agg(F.count(F.lit(1)).alias("df_new"))
    table = (vocab.table.join(df, "term", "left")
             .withColumn("df", F.coalesce(F.col("df_new"), F.lit(0)).cast("long"))
             .withColumn("idf", idf_expr("df", n_docs, cfg.use_idf, cfg.smooth_idf))
             .select("term_id", "term", "df", "ctf", "idf")).checkpoint(eager=True)
    return vocab.with_table(table, n_docs)
