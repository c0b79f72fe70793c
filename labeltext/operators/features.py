"""TF-IDF features.

The vocabulary comes from map-side partial sums per term; it is bounded by ``max_features``.
Applying it is a map over the rows: Spark tokenises, an Arrow stage looks all n-grams of a batch
up in the vocabulary, a piece of bounded size at a time, and adds up each document. No text, token or key is shuffled, and rows
with equal or null keys are documents of their own."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labeltext.functions.batches import bounded, pieces, releasing
from labeltext.functions.text import analyzed_text, tokens
from labeltext.schema import KEY, MAX_DF, MAX_FEATURES, MIN_DF, NGRAM_RANGE, TEXT

# Tokens that are looked up at a time; a longer text is a piece of its own.
PIECE_TOKENS = 1 << 17


@dataclass(frozen=True)
class TfidfParams:
    max_features: int = MAX_FEATURES
    ngram_range: tuple[int, int] = NGRAM_RANGE
    min_df: int = MIN_DF
    max_df: float = MAX_DF
    lowercase: bool = True
    strip_accents: bool = True


def _grams(tokens_: str, low: int, high: int) -> Column:
    """All n-grams of a token array column, as one array."""
    size = F.size(tokens_)
    grams, kept = F.col(tokens_), [F.col(tokens_)] if low == 1 else []
    for n in range(2, high + 1):
        count = F.greatest(size - (n - 1), F.lit(0))
        grams = F.zip_with(
            F.slice(grams, F.lit(1), count),
            F.slice(tokens_, F.lit(n), count),
            lambda head, last: F.concat(head, F.lit(" "), last),
        )
        if n >= low:
            kept.append(grams)
    return F.concat(*kept)


def term_totals(
    df: DataFrame, params: TfidfParams = TfidfParams(), text: str = TEXT
) -> DataFrame:
    """term, tf (corpus count) and df (documents). Each text gives its terms and its distinct
    terms, both summed up by term with map-side partial sums; no text and no per-document count
    is shuffled."""
    grams = bounded(df).select(_tokens(params, text)).select(
        _grams("_tokens", *params.ngram_range).alias("_grams")
    )
    both = F.array(
        F.struct(F.col("_grams").alias("terms"), F.lit(1).alias("tf"), F.lit(0).alias("df")),
        F.struct(F.array_distinct("_grams").alias("terms"), F.lit(0).alias("tf"), F.lit(1).alias("df")),
    )
    return (
        grams.select(F.inline(both))
        .select(F.explode("terms").alias("term"), "tf", "df")
        .groupBy("term")
        .agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    )


def _tokens(params: TfidfParams, text: str) -> Column:
    return tokens(analyzed_text(F.col(text), params.lowercase, params.strip_accents)).alias("_tokens")


def vocabulary(
    df: DataFrame, params: TfidfParams = TfidfParams(), text: str = TEXT
) -> DataFrame:
    """term, term_id (position in term order), tf (corpus count), df, idf. At most
    ``max_features`` rows: the most frequent terms, the alphabetically first on ties."""
    n_docs = df.agg(F.count(F.lit(1))).scalar()
    totals = term_totals(df, params, text)
    kept = (
        totals.where(F.col("df") >= params.min_df)
        .where(F.col("df") <= F.lit(params.max_df) * n_docs)
        .orderBy(F.col("tf").desc(), "term")
        .limit(params.max_features)
    )
    # The capped table, never the whole vocabulary, is numbered in one piece.
    position = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("term")) - 1
    idf = F.ln((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0
    return kept.select(
        "term", position.cast("bigint").alias("term_id"), "tf", "df", idf.alias("idf")
    )


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores before it until no column in ``taken`` has it."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name


class Lookup:
    """A vocabulary as a trie of its terms' tokens, one level per n-gram length; applied to
    whole batches. ``columns`` are further numbers of the terms."""

    def __init__(self, vocab: DataFrame, columns: list[str] | None = None):
        # At most max_features rows, by the vocabulary's construction.
        rows = vocab.select("term_id", "term", "idf", *(columns or [])).orderBy("term_id").collect()
        self.term_id = np.array([r[0] for r in rows], np.int64)
        self.idf = np.array([r[2] for r in rows], np.float64)
        self.columns = [
            np.array([r[3 + k] for r in rows], np.float64) for k in range(len(columns or []))
        ]
        split = [r[1].split(" ") for r in rows]
        names = sorted({token for term in split for token in term})
        self.tokens, number = pa.array(names, pa.string()), {t: k for k, t in enumerate(names)}
        self.size = len(names)
        # Per level: the sorted edges (node * tokens + token) and the term that ends there or -1.
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        nodes = {(): 0}
        for n in range(1, max(map(len, split), default=1) + 1):
            edges = {
                nodes[tuple(term[: n - 1])] * self.size + number[term[n - 1]]: tuple(term[:n])
                for term in split if len(term) >= n
            }
            order = sorted(edges)
            nodes = {edges[e]: k for k, e in enumerate(order)}
            ends = np.full(len(order), -1, np.int64)
            for k, term in enumerate(split):
                if len(term) == n:
                    ends[nodes[tuple(term)]] = k
            self.levels.append((np.array(order, np.int64), ends))

    def weights(self, lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, row of the vocabulary, sublinear tf times idf), sorted by both."""
        many = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
        code = pc.fill_null(pc.index_in(lists.flatten(), value_set=self.tokens), -1).to_numpy()
        code = code.astype(np.int64)
        doc = np.repeat(np.arange(len(many)), many)
        found, at, node = [], np.arange(len(code)), np.zeros(len(code), np.int64)
        for n, (edges, ends) in enumerate(self.levels):
            inside = at + n < len(code)
            at, node = at[inside], node[inside]
            known = (code[at + n] >= 0) & (doc[at + n] == doc[at])
            at, node = at[known], node[known]
            if not len(edges) or not len(at):
                break
            edge = node * self.size + code[at + n]
            place = np.minimum(np.searchsorted(edges, edge), len(edges) - 1)
            good = edges[place] == edge
            at, node = at[good], place[good]
            whole = ends[node] >= 0
            found.append(doc[at[whole]] * len(self.idf) + ends[node[whole]])
        pairs = np.concatenate(found) if found else np.zeros(0, np.int64)
        pairs, tf = np.unique(pairs, return_counts=True)
        doc, row = np.divmod(pairs, max(len(self.idf), 1))
        return doc, row, (1.0 + np.log(tf)) * self.idf[row]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``PIECE_TOKENS`` tokens, which are the last column."""
    for batch in batches:
        many = pc.fill_null(pc.list_value_length(batch.column(batch.num_columns - 1)), 0)
        for start, end in pieces(many.to_numpy(), PIECE_TOKENS):
            yield batch.slice(start, end - start)


def document_weights(
    df: DataFrame,
    vocab: DataFrame,
    params: TfidfParams = TfidfParams(),
    text: str = TEXT,
    keep: list[str] | None = None,
) -> DataFrame:
    """A row per row of ``df``: kept columns, ``indices`` (term ids, rising) and ``values``:
    sublinear tf times idf, scaled to length 1. Both are empty without a known term."""
    lookup, keep = Lookup(vocab), keep or [KEY]
    rows = bounded(df).select(*keep, _tokens(params, text).alias(free_name(keep, "tokens")))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            doc, row, weight = lookup.weights(batch.column(len(keep)))
            length = np.sqrt(np.bincount(doc, weight * weight, batch.num_rows))
            ends = np.cumsum(np.bincount(doc, minlength=batch.num_rows))
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            columns = [
                pa.ListArray.from_arrays(offsets, pa.array(lookup.term_id[row], pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(weight / length[doc], pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*keep, "indices", "values"])

    kinds = [
        *df.select(*keep).schema.fields,
        T.StructField("indices", T.ArrayType(T.IntegerType())),
        T.StructField("values", T.ArrayType(T.DoubleType())),
    ]
    return rows.mapInArrow(releasing(apply), T.StructType(kinds))


def document_sums(
    df: DataFrame,
    vocab: DataFrame,
    columns: list[str],
    params: TfidfParams = TfidfParams(),
    text: str = TEXT,
    keep: list[str] | None = None,
) -> DataFrame:
    """A row per row of ``df``: kept columns and, for each of the vocabulary's ``columns``, the
    sum of its values times the document's scaled weights; 0 without a known term. A sum is
    named like its column, or ``free_name`` if a kept column has that name."""
    lookup, keep = Lookup(vocab, columns), keep or [KEY]
    names = [free_name(keep, c) for c in columns]
    rows = bounded(df).select(*keep, _tokens(params, text).alias(free_name(keep, "tokens")))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            doc, row, weight = lookup.weights(batch.column(len(keep)))
            length = np.sqrt(np.bincount(doc, weight * weight, batch.num_rows))
            length[length == 0] = 1.0
            sums = [
                pa.array(np.bincount(doc, weight * values[row], batch.num_rows) / length)
                for values in lookup.columns
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *sums], [*keep, *names])

    kinds = [*df.select(*keep).schema.fields, *[T.StructField(c, T.DoubleType()) for c in names]]
    return rows.mapInArrow(releasing(apply), T.StructType(kinds))


def tfidf_weights(
    df: DataFrame,
    vocab: DataFrame,
    params: TfidfParams = TfidfParams(),
    key: str = KEY,
    text: str = TEXT,
    keep: list[str] | None = None,
) -> DataFrame:
    """``document_weights`` as a long table: (key, kept columns, term_id, weight). Documents
    without a known term have no rows."""
    carried = [key, *(keep or [])]
    arrays = document_weights(df, vocab, params, text, carried)
    return arrays.select(*carried, F.inline(F.arrays_zip("indices", "values"))).select(
        *carried, F.col("indices").cast("bigint").alias("term_id"), F.col("values").alias("weight")
    )


def feature_vectors(arrays: DataFrame, n_features: int) -> DataFrame:
    """The feature arrays with a sparse ``features`` vector, for estimators of Spark ML. A
    batch of vectors is made of the arrays as they are."""
    names = [f.name for f in arrays.schema]

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = pa.array(np.zeros(batch.num_rows, np.int8))
            size = pa.array(np.full(batch.num_rows, n_features, np.int32))
            vector = pa.StructArray.from_arrays(
                [kind, size, batch.column("indices"), batch.column("values")],
                ["type", "size", "indices", "values"],
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, vector], [*names, "features"])

    kinds = [*arrays.schema.fields, T.StructField("features", VectorUDT())]
    return bounded(arrays).mapInArrow(releasing(sparse), T.StructType(kinds))
