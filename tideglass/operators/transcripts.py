"""Transcripts: recursive splitting, merging to chunks, chunk records, their validation and upsert, and nearest vectors."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate, pairwise

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideglass.functions.scalars import pad_cik
from tideglass.functions.timeparse import let

c = F.col
SIZE, WINDOW_TOKENS, FEWEST = 50, 800, 4
# Separators from the strongest to none.
SEPARATORS = ("\n\n", "\n", ".", "?", "!", " ", "")


def split_text(text: str, size: int = SIZE, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Pieces of at most `size` characters, cut at the strongest separator that occurs; separators stay at the front of what
    follows, neighbours are joined while they fit, and blank pieces drop out."""
    mark = next((s for s in separators if s == "" or s in text), "")
    finer = separators[separators.index(mark) + 1 :]
    if mark:
        head, *tail = text.split(mark)
        parts = [head, *(mark + t for t in tail)]
    else:
        parts = list(text)
    out: list[str] = []
    held = ""
    for part in parts:
        if held and (len(part) >= size or len(held) + len(part) > size):
            out.append(held.strip())
            held = ""
        if len(part) < size:
            held += part
        else:
            out += split_text(part, size, finer) if finer else [part.strip()]
    return [x for x in (*out, held.strip()) if x]


#: Given the pieces and the first and last of a window, the numbers (from 1) of those after which a chunk ends.
Oracle = Callable[[list[str], int, int], list[int]]


def midpoint(pieces: list[str], current: int, end: int) -> list[int]:
    """The default split oracle: no answer, so the middle of the window is taken."""
    return [current + (end - current) // 2]


def chunk_ends(sizes: list[int], window: int, choose: Callable[[int, int], list[int]]) -> Iterator[int]:
    """Numbers of pieces after which a chunk ends, until no more than FEWEST pieces are left. A window is the pieces from the last
    end on whose sizes add up to `window`, found in the running totals; one piece that is larger is a chunk."""
    total = [0, *accumulate(sizes)]
    first = 0
    while first + FEWEST < len(sizes):
        last = max(bisect_right(total, total[first] + window) - 2, first)
        found = choose(first, last) if last > first else [first + 1]
        yield from found
        first = max(found[-1], first + 1)


def merge_pieces(text: str, size: int = SIZE, window: int = WINDOW_TOKENS, oracle: Oracle = midpoint) -> list[str]:
    """Chunks of a text: its pieces in windows of `window` tokens (a quarter of the characters), which end where the oracle says. Up to
    FEWEST pieces are one chunk. No answer means the midpoint; of an answer what lies outside the window is left out, and where nothing
    is left the window's first piece is a chunk."""
    pieces = split_text(text, size)
    if len(pieces) <= FEWEST:
        return [text]

    def choose(first: int, last: int) -> list[int]:
        said = oracle(pieces, first, last) or midpoint(pieces, first, last)
        return [x for x in said if first <= x <= last] or [first + 1]

    cuts = sorted({0, len(pieces), *chunk_ends([len(p) // 4 for p in pieces], window, choose)})
    return [" ".join(pieces[a:b]).strip() for a, b in pairwise(cuts)]


def chunk_documents(documents: DataFrame, key: str, text: str, oracle: Oracle = midpoint) -> DataFrame:
    """key, chunk_index (from 1), chunk. Null, empty and blank texts have no chunks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            rows = [(k, i, x) for k, t in zip(part[key], part[text], strict=True) if t and t.strip() for i, x in enumerate(merge_pieces(t, oracle=oracle), 1)]
            yield pd.DataFrame(rows, columns=[key, "chunk_index", "chunk"])

    return documents.select(key, text).mapInPandas(run, f"`{key}` {documents.schema[key].dataType.simpleString()}, chunk_index int, chunk string")


#: White space of any kind, for Java and RE2.
BLANKS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{BLANKS}+|{BLANKS}+$", "")


def chunk_records(chunks: DataFrame) -> DataFrame:
    """metadata and chunk from chunks with date, ticker, year, quarter, cik, doc_id, doc_type (transcript if absent), chunk_index.

    Rows without a required field or with a date that isn't yyyy-MM-dd are left out."""
    required = ("date", "ticker", "year", "quarter", "cik")
    good = F.try_to_date("date", "yyyy-MM-dd").isNotNull() & c("date").rlike(r"^\d{4}-\d{2}-\d{2}$")
    for x in required:
        good = good & c(x).isNotNull()
    name = F.concat(c("ticker"), F.lit("_"), c("year"), F.lit("_Q"), c("quarter"), F.lit(".json"))
    meta = F.struct(c("date"), F.upper("ticker").alias("ticker"), c("year").cast("int").alias("year"), c("quarter").cast("int").alias("quarter"), c("chunk_index"), pad_cik(c("cik")).alias("cik"), c("doc_id").cast("string").alias("doc_id"), F.coalesce("doc_type", F.lit("transcript")).alias("doc_type"), name.alias("source_file"))
    return chunks.where(good).select(meta.alias("metadata"), strip(c("chunk")).alias("chunk"))


def chunk_problem(metadata: Column, chunk: Column, embedding: Column) -> Column:
    """Null for a valid chunk document, else the first test that it fails."""
    missing = F.array_compact(F.array(*(F.when(metadata[x].isNull(), F.lit(x)) for x in ("ticker", "year", "quarter", "chunk_index", "doc_id"))))
    return (
        F.when(metadata.isNull(), "missing metadata")
        .when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ", ")))
        .when(~metadata["quarter"].between(1, 4), F.concat(F.lit("invalid quarter "), metadata["quarter"].cast("string")))
        .when(chunk.isNull() | (F.trim(F.regexp_replace(chunk, r"\s", " ")) == ""), "empty chunk")
        .when(embedding.isNull() | (F.size(embedding) == 0), "empty embedding")
        .when(F.exists(embedding, lambda x: x.isNull() | F.isnan(x)), "embedding isn't numeric")
    )


def upsert_counts(new: DataFrame, old: DataFrame, key: list[str]) -> DataFrame:
    """status and n: how many rows of new (key, content, problem) would be inserted, updated, skipped as equal, or are errors."""
    look = old.select(*key, c("content").alias("before"), F.lit(True).alias("there"))
    joined = new.join(look, key, "left")
    status = F.when(c("problem").isNotNull(), "error").when(c("there").isNull(), "inserted").when(c("content").eqNullSafe(c("before")), "skipped").otherwise("updated")
    return joined.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def split_ids(answer: Column) -> Column:
    """The numbers of the first line with `split_after:`; empty if there is none."""
    line = F.get(F.filter(F.split(answer, "\n"), lambda x: F.lower(x).contains("split_after:")), F.lit(0))
    return F.coalesce(F.transform(F.regexp_extract_all(line, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.cast("int")), F.expr("cast(array() as array<int>)"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return let(size, lambda s: F.when(s > 0, dot(a, b) / s))


def _blocks(rows: DataFrame, key: str, size: int) -> tuple[DataFrame, int]:
    """block, rows: the rows in blocks of about `size`, and how many blocks there are."""
    n = max(1, -(-rows.count() // size))
    block = F.pmod(F.xxhash64(key), F.lit(n))
    return rows.groupBy(block.alias("block")).agg(F.collect_list(F.struct(c(key).alias("id"), "embedding")).alias("rows")), n


def nearest_vectors(vectors: DataFrame, queries: DataFrame, k: int = 5, vector_block: int = 1024, query_block: int = 256) -> DataFrame:
    """query_id, vec_id, score, rank: the k vectors of greatest cosine to each query, itself left out; exact, ties by vec_id.

    vectors: vec_id, embedding; queries: query_id, embedding, a stated set that is compared with all rows, in blocks: each block of
    queries meets each block of vectors in one matrix product, from which k candidates per query go on. Vectors that are null,
    empty or zero match nothing, nor do those of another length than the query."""
    import numpy as np

    def arrays(rows, dim: int):
        kept = [r for r in rows if len(r["embedding"]) == dim]
        m = np.array([r["embedding"] for r in kept], np.float64).reshape(len(kept), dim)
        size = np.linalg.norm(m, axis=1)
        ok = np.isfinite(size) & (size > 0)
        return np.array([r["id"] for r in kept], np.int64)[ok], m[ok] / size[ok][:, None]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for vs, qs in zip(part["rows"], part["qs"], strict=True):
                for dim in {len(q["embedding"]) for q in qs}:
                    ids, v = arrays(vs, dim)
                    names, q = arrays(qs, dim)
                    if not len(ids) or not len(names):
                        continue
                    score = q @ v.T
                    score[names[:, None] == ids[None, :]] = -np.inf
                    order = np.lexsort((np.broadcast_to(ids, score.shape), -score), axis=1)[:, :k]
                    top = np.take_along_axis(score, order, axis=1)
                    out = pd.DataFrame({"query_id": np.repeat(names, order.shape[1]), "vec_id": ids[order].ravel(), "score": top.ravel()})
                    yield out[np.isfinite(out["score"])]

    good = c("embedding").isNotNull() & (F.size("embedding") > 0)
    v, n = _blocks(vectors.where(good).select("vec_id", "embedding"), "vec_id", vector_block)
    q, _ = _blocks(queries.where(good).select("query_id", "embedding"), "query_id", query_block)
    spread = q.select(c("rows").alias("qs"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))).alias("block"))
    found = v.join(spread, "block").select("rows", "qs").mapInPandas(run, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(c("rank") <= k)
