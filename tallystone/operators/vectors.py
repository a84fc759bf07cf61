"""Embeddings and exact filtered cosine top-k search.

Spark SQL has no vector type or cosine function; vectors are
``ARRAY<FLOAT>`` columns. Search is an exact scan of a stated query set
against all items, in blocks: both sides are packed into rows that hold up to
``QUERY_BLOCK`` queries or ``ITEM_BLOCK`` items, every pair of blocks is one
dense matrix product inside a task, and of each product only the best ``k``
items of each query become rows. Queries stay distributed: nothing is
collected, and declaring a search runs no job. A final ``row_number() <= k``
per query (partial ``WindowGroupLimit`` before its shuffle) merges the candidates.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.functions.text import word_tokens
from tallystone.schemas import DEFAULT_TOP_K, EMBEDDING_BATCH_SIZE

# Rows of one packed block; a distance matrix has at most their product of entries.
QUERY_BLOCK = 512
ITEM_BLOCK = 4096
DISTANCE_DIGITS = 6


def _blocks(src: DataFrame, rows: int) -> DataFrame:
    """``(row struct, _v array<double>)`` rows packed by partition: up to ``rows``
    structs in order of their first field, and their unit vectors end to end.
    Zero and non-finite vectors are left out; two widths in one partition raise."""
    def pack(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        width = None
        for rb in (b.slice(i, rows) for b in batches for i in range(0, b.num_rows, rows)):
            col = rb.column("_v")
            lens = pc.list_value_length(col).to_numpy(zero_copy_only=False)
            width = int(lens[0]) if width is None else width
            if (lens != width).any():
                raise ValueError(f"vectors of different widths: {width} and {int(lens[lens != width][0])}")
            # the list values are one flat buffer: reshape, no per-row Python
            v = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
            n = np.linalg.norm(v, axis=1)
            order = pc.sort_indices(rb.column("_row").field(0)).to_numpy()
            order = order[(np.isfinite(n) & (n > 0))[order]]
            if len(order):
                unit = (v[order] / n[order][:, None]).ravel()
                part = rb.column("_row").take(pa.array(order))
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part),
                     pa.ListArray.from_arrays(pa.array([0, len(unit)], pa.int32()), pa.array(unit))],
                    names=["rows", "units"])

    schema = T.StructType([T.StructField("rows", T.ArrayType(src.schema["_row"].dataType)),
                           T.StructField("units", T.ArrayType(T.DoubleType()))])
    return src.mapInArrow(pack, schema)


def vector_search(items: DataFrame, queries: DataFrame, k: int = DEFAULT_TOP_K,
                  id_col: str = "id", vec_col: str = "embedding", qid_col: str = "qid",
                  qvec_col: str = "embedding", payload: Sequence[str] = (),
                  any_of: dict[str, Sequence] | None = None, equals: dict | None = None,
                  ilike: dict[str, str] | None = None) -> DataFrame:
    """Exact cosine top-k for every query (V2).

    Filters run first and reach the scan: ``any_of`` (column -> allowed
    values; upper-case them for tickers; an empty list means no filter),
    ``equals`` (column -> value), ``ilike`` (column -> substring, case
    insensitive; ``%``/``_`` act as wildcards as in the reference).
    Output: qid, rank (1-based), id, payload..., distance (rounded to 6
    places); ties by id (a number, date or string). NULL, empty, zero and
    non-finite vectors never rank (T20); no queries: no rows; vectors of
    another width than a query's: an error.

    Every block of queries meets every block of items: the planner sends the
    smaller side to the tasks if its size is below the broadcast threshold,
    else it pairs partitions. The rows are blocks, never pairs of vectors.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    f = items
    for c, vals in (any_of or {}).items():
        if vals:
            f = f.filter(F.col(c).isin(list(vals)))
    for c, v in (equals or {}).items():
        f = f.filter(F.col(c) == F.lit(v))
    for c, sub in (ilike or {}).items():
        f = f.filter(F.col(c).ilike(f"%{sub}%"))

    keep_cols = [id_col] + [c for c in payload if c != id_col]

    def side(df: DataFrame, cols: Sequence[str], vec: str) -> DataFrame:
        return df.filter(F.size(vec) > 0).select(F.struct(*cols).alias("_row"), F.col(vec).alias("_v"))

    qs = side(queries.select(qid_col, qvec_col).distinct(), [qid_col], qvec_col)
    pairs = (_blocks(side(f, keep_cols, vec_col), ITEM_BLOCK)
             .crossJoin(_blocks(qs, QUERY_BLOCK).toDF("q_rows", "q_units")))
    fields = [queries.schema[qid_col]] + [f.schema[c] for c in keep_cols]
    names = [qid_col, *keep_cols, "distance"]

    def topk(batches):
        import pyarrow as pa
        for rb in batches:
            for i in range(rb.num_rows):
                items, asked = rb.column("rows")[i].values, rb.column("q_rows")[i].values
                mat, unit = (rb.column(c)[i].values.to_numpy().reshape(n, -1)
                             for c, n in (("q_units", len(asked)), ("units", len(items))))
                if mat.shape[1] != unit.shape[1]:
                    raise ValueError("vector width differs from the query width")
                # distance in whole steps, then position (the items are in id order): no two keys alike
                key = np.rint((1.0 - mat @ unit.T) * 10 ** DISTANCE_DIGITS).astype(np.int64)
                key = key * len(items) + np.arange(len(items))
                if len(items) > k:
                    key = np.partition(key, k - 1, axis=1)[:, :k]
                step, at = np.divmod(key, len(items))
                who = pa.array(np.repeat(np.arange(len(asked)), key.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [*asked.take(who).flatten(), *items.take(pa.array(at.ravel())).flatten(),
                     pa.array(step.ravel() / 10 ** DISTANCE_DIGITS)], names=names)

    cand = pairs.mapInArrow(topk, T.StructType(fields + [T.StructField("distance", T.DoubleType())]))
    # a query id may have several vectors: ranked once over all of them
    w = Window.partitionBy(qid_col).orderBy(F.col("distance").asc(), F.col(id_col).asc())
    return (cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select(qid_col, "rank", *keep_cols, "distance"))


def centroids(items: DataFrame, group_col: str, vec_col: str = "embedding",
              out_col: str = "embedding") -> DataFrame:
    """Element-wise mean vector per group: one partial sum vector per task and group."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    v = array_to_vector(F.col(vec_col).cast("array<double>"))
    return (items.filter(F.size(vec_col) > 0).groupBy(group_col)
            .agg(vector_to_array(Summarizer.mean(v)).alias(out_col)))


# ---------------------------------------------------------------------------
# Embedding (V1)
# ---------------------------------------------------------------------------

def hashing_embedder_model(dim: int) -> str:
    return f"hashing-tf-l2-{dim}"


def embed_chunks(chunks: DataFrame, text_col: str = "chunk_text", dim: int = 1536,
                 embedder: Callable[[pd.Series], np.ndarray] | None = None,
                 model_id: str | None = None, out_col: str = "embedding",
                 batch_size: int = EMBEDDING_BATCH_SIZE) -> DataFrame:
    """Attach a vector and the id of the model that made it.

    Default: JVM-side hashed term frequencies of the word tokens (Spark ML
    ``HashingTF``), L2-normalised, as ``ARRAY<FLOAT>`` — deterministic and
    offline. ``embedder`` plugs in any batch model: it receives a pandas
    Series of texts (Arrow batches; size them with
    ``spark.sql.execution.arrow.maxRecordsPerBatch``) and returns an
    (n, dim) array. Query and chunks must use the same ``model_id``.
    """
    if embedder is None:
        from pyspark.ml.feature import HashingTF, Normalizer
        from pyspark.ml.functions import vector_to_array
        toks = chunks.withColumn("_toks", word_tokens(F.col(text_col)))
        tf = HashingTF(numFeatures=dim, inputCol="_toks", outputCol="_tf").transform(toks)
        nz = Normalizer(p=2.0, inputCol="_tf", outputCol="_unit").transform(tf)
        return (nz.withColumn(out_col, vector_to_array("_unit", "float32"))
                .withColumn("embed_model", F.lit(model_id or hashing_embedder_model(dim)))
                .drop("_toks", "_tf", "_unit"))

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _embed(texts: pd.Series) -> pd.Series:
        parts = [np.asarray(embedder(texts.iloc[i:i + batch_size]), dtype=np.float32)
                 for i in range(0, len(texts), batch_size)]
        arr = np.concatenate(parts) if parts else np.zeros((0, 0), dtype=np.float32)
        return pd.Series(list(arr))

    return (chunks.withColumn(out_col, _embed(F.col(text_col)))
            .withColumn("embed_model", F.lit(model_id or "custom")))


def require_model(chunks: DataFrame, model_id: str, vec_col: str = "embedding",
                  model_col: str = "embed_model") -> DataFrame:
    """``chunks`` whose vectors raise while they are read if another model, or
    an unknown one (NULL), made them; no job of its own."""
    kind = chunks.schema[vec_col].dataType
    wrong = F.raise_error(F.concat(F.lit("chunks embedded with "), F.coalesce(model_col, F.lit("an unknown model")),
                                   F.lit(f", query with {model_id}"))).cast(kind)
    return chunks.withColumn(vec_col, F.when(F.col(model_col).eqNullSafe(F.lit(model_id)), F.col(vec_col))
                             .otherwise(wrong))


def with_similarity(results: DataFrame, distance_col: str = "distance") -> DataFrame:
    """(1 - cosine distance) x 100."""
    return results.withColumn("similarity_pct", (F.lit(1.0) - F.col(distance_col)) * F.lit(100.0))


def search_preview(results: DataFrame, section_col: str = "section", text_col: str = "chunk_text",
                   section_chars: int = 60, text_chars: int = 300) -> DataFrame:
    """Display columns (P14): section prefix, text prefix with newlines as spaces."""
    return (results.withColumn("section_preview", F.substring(F.col(section_col), 1, section_chars))
            .withColumn("text_preview", F.translate(F.substring(F.col(text_col), 1, text_chars), "\n", " ")))


SEARCH_COLS = ["ticker", "company_name", "form", "fiscal_year", "fiscal_period", "section",
               "chunk_index", "chunk_text", "accession_number"]


def search(chunks: DataFrame, queries: DataFrame, k: int = DEFAULT_TOP_K,
           tickers: list[str] | None = None, form: str | None = None,
           section_contains: str | None = None, dim: int = 1536,
           embedder: Callable[[pd.Series], np.ndarray] | None = None, model_id: str | None = None,
           qid_col: str = "qid", text_col: str = "text", id_col: str = "chunk_id",
           payload: Sequence[str] = SEARCH_COLS) -> DataFrame:
    """Top-k chunks for query texts (V1 + V2 together).

    The query texts are embedded with the same model as the chunks (the
    stored ``embed_model`` is checked as they are read), then searched with the reference's
    filters: tickers (upper-cased, any of), form, section substring.
    Output: qid, rank, chunk id, payload, distance, similarity_pct.
    """
    model = model_id or (hashing_embedder_model(dim) if embedder is None else "custom")
    if "embed_model" in chunks.columns:
        chunks = require_model(chunks, model)
    q = embed_chunks(queries.select(qid_col, text_col), text_col=text_col, dim=dim,
                     embedder=embedder, model_id=model).select(qid_col, "embedding")
    res = vector_search(chunks, q, k=k, id_col=id_col, qid_col=qid_col,
                        payload=[c for c in payload if c in chunks.columns],
                        any_of={"ticker": [t.upper() for t in tickers]} if tickers else None,
                        equals={"form": form} if form else None,
                        ilike={"section": section_contains} if section_contains else None)
    return with_similarity(res)
