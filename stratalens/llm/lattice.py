"""Subword lattice likelihood: the marginal probability of a text over all segmentations.

The vocabulary is an existing one (a sentencepiece model file); its pieces' scores are
log probabilities, counted over the training texts as that vocabulary segments them, with
one added to each count.  The probability of a text is the sum over every way to spell
it in pieces, by forward recursion in log space, times that of the end piece.

A piece holds the mark of a word's start at most as its first character, so every
segmentation of a text breaks where words begin.  The sum over the text is then the product of the
sums over its words, and each distinct word is walked through once for the whole corpus.

Words of texts are looked up by block, not by document: a block is a run of texts of about
``block_characters`` characters.  It keeps its texts as positions in the block's own word list, and only the
lists travel through the joins with counts and word scores, where a word has one row per block.

Next to it stands the base model: words with one added to each count.

Defined results: NULL text is empty and has the end token alone.  NULL ids count as
not held out.  Repeated rows are scored and counted each.  Without training texts every count is 0.
Characters the vocabulary lacks are spelled in its byte pieces.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import new_folder, words

START = "▁"
BLOCK_ROWS = "block string, doc_id long, held_out boolean, n_tokens long, places binary, times binary, place int, word string, train long"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _blocks(docs: DataFrame, path: str, block_characters: int) -> tuple[DataFrame, DataFrame]:
    """Texts as places in their block's word list, and the lists: written once, read as two tables."""
    kind = pa.schema([
        ("block", pa.string()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
        ("places", pa.binary()), ("times", pa.binary()), ("place", pa.int32()), ("word", pa.string()), ("train", pa.int64()),
    ])

    def cut(batches):
        task, number = TaskContext.get().partitionId(), 0
        places, texts, size = {}, [], 0

        def flush():
            nonlocal places, texts, size, number
            train = np.zeros(len(places), dtype=np.int64)
            for _, held_out, _, at, times in texts:
                if not held_out:
                    train[at] += times
            told = [[d for d, *_ in texts], [h for _, h, *_ in texts], [n for _, _, n, *_ in texts],
                    [at.tobytes() for *_, at, _ in texts], [times.tobytes() for *_, times in texts]]
            listed = [np.arange(len(places), dtype=np.int32), [w.decode() for w in places], train]
            for first, columns, length in ((1, told, len(texts)), (6, listed, len(places))):
                arrays = [pa.nulls(length, f.type) for f in kind]
                arrays[0] = pa.array([f"{task}-{number}"] * length, pa.string())
                for k, values in enumerate(columns, first):
                    arrays[k] = pa.array(values, kind.field(k).type)
                yield pa.RecordBatch.from_arrays(arrays, schema=kind)
            number, places, texts, size = number + 1, {}, [], 0

        for batch in batches:
            for doc_id, held_out, text in zip(*(c.to_pylist() for c in batch.columns)):
                w = words(text)
                counted = Counter(w)
                at = np.fromiter((places.setdefault(x, len(places)) for x in counted), dtype=np.int32, count=len(counted))
                times = np.fromiter(counted.values(), dtype=np.int32, count=len(counted))
                order = np.argsort(at)
                texts.append((doc_id, held_out, len(w) + 1, at[order], times[order]))
                size += len(text or "") + 100
                if size >= block_characters:
                    yield from flush()
        if texts:
            yield from flush()

    rows = docs.mapInArrow(cut, BLOCK_ROWS)
    rows.write.option("compression", "zstd").parquet(path)
    texts, lists = (docs.sparkSession.read.schema(BLOCK_ROWS).parquet(path) for _ in range(2))
    return texts.where("word IS NULL").select(*kind.names[:6]), lists.where("word IS NOT NULL").select("block", "place", "word", "train")


class Lattice:
    """Log probabilities of pieces, and the forward recursion over a word."""

    def __init__(self, model_path: str, counts: dict[int, int], ends: int):
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        usable = [i for i in range(len(model)) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        usable = [i for i in usable if START not in model.id_to_piece(i)[1:]]
        total = sum(counts.get(i, 0) for i in usable) + ends + len(usable) + 1
        log = {i: math.log((counts.get(i, 0) + 1) / total) for i in usable}
        self.end = math.log((ends + 1) / total)
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): log[i] for i in usable if model.is_byte(i)}
        self.pieces = {model.id_to_piece(i): log[i] for i in usable if not model.is_byte(i)}
        self.heads = {p[:n] for p in self.pieces for n in range(1, len(p) + 1)}

    def log_probability(self, word: str) -> float:
        """The log of the summed probability of all spellings of a word."""
        text = START + word
        last = len(text)
        forward = [0.0] + [-math.inf] * last
        pieces, heads, exp, log1p = self.pieces, self.heads, math.exp, math.log1p
        for i in range(last):
            here, j = forward[i], i + 1
            while j <= last and (head := text[i:j]) in heads:
                if (p := pieces.get(head)) is not None:
                    new, old = here + p, forward[j]
                    forward[j] = new + log1p(exp(old - new)) if new >= old else old + log1p(exp(new - old))
                j += 1
            if text[i] not in pieces:
                new, old = here + sum(self.bytes[b] for b in text[i].encode()), forward[i + 1]
                forward[i + 1] = new + log1p(exp(old - new)) if new >= old else old + log1p(exp(new - old))
        return forward[last]


def _piece_counts(vocabulary: DataFrame, model_path: str) -> dict[int, int]:
    """How often the vocabulary's own segmentation uses each piece; the driver holds one number per piece."""

    def count(batches):
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        totals = np.zeros(len(model), dtype=np.int64)
        for pdf in batches:
            for ids, n in zip(model.encode(pdf["word"].tolist(), num_threads=1), pdf["n"]):
                for i in ids:
                    totals[i] += n
        used = np.flatnonzero(totals)
        yield pd.DataFrame({"piece": used, "n": totals[used]})

    found = vocabulary.where("n > 0").mapInPandas(count, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return {r.piece: r.n for r in found.collect()}


def score_texts(
    docs: DataFrame,
    model_path: str,
    held_out: Column,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_characters: int = 16_000_000,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row; log10 scores.

    Texts where ``held_out`` is true are scored and not learned from.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_column).alias("text")
    )
    texts, lists = _blocks(rows, new_folder(spark, "blocks"), block_characters)
    counted = new_folder(spark, "words")
    lists.groupBy("word").agg(F.sum("train").alias("n")).write.parquet(counted)
    vocabulary = spark.read.parquet(counted)
    known = vocabulary.where("n > 0").agg(F.count("*").alias("distinct"), F.sum("n").alias("tokens")).first()
    ends = texts.where(~F.col("held_out")).count()
    tokens, distinct = (known.tokens or 0) + ends, known.distinct + (ends > 0)
    lattice = spark.sparkContext.broadcast(Lattice(model_path, _piece_counts(vocabulary, model_path), ends))

    def weigh(batches):
        one = lattice.value.log_probability
        for pdf in batches:
            yield pd.DataFrame({"word": pdf["word"], "n": pdf["n"], "spelled": [one(w) for w in pdf["word"]]})

    weighed = vocabulary.mapInPandas(weigh, "word string, n long, spelled double")
    values = lists.select("block", "place", "word").join(weighed, "word").select("block", "place", "n", "spelled")
    end_known, end_base, per_token = int(ends > 0), math.log10(ends + 1), math.log10(tokens + distinct + 1)
    end_score, to_log10 = lattice.value.end, 1 / math.log(10)

    def finish(told: pd.DataFrame, listed: pd.DataFrame) -> pd.DataFrame:
        size = len(listed)
        n, spelled = np.zeros(size, dtype=np.int64), np.zeros(size)
        n[listed["place"]], spelled[listed["place"]] = listed["n"], listed["spelled"]
        base, seen = np.log10(n + 1.0), n > 0
        out = []
        for at, times in zip(told["places"], told["times"]):
            at, times = np.frombuffer(at, dtype=np.int32), np.frombuffer(times, dtype=np.int32)
            out.append((int(times @ seen[at]), float(times @ base[at]), float(times @ spelled[at])))
        known, base_sum, spelled_sum = (np.array(x) for x in zip(*out)) if out else (np.zeros(0),) * 3
        told["n_known"] = (known + end_known).astype(np.int64)
        told["base_score"] = base_sum + end_base - told["n_tokens"].astype(float) * per_token
        told["score"] = (spelled_sum + end_score) * to_log10
        return told[[f.split()[0] for f in SCORES.split(", ")]]

    scored = texts.groupBy("block").cogroup(values.groupBy("block")).applyInPandas(finish, SCORES)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
