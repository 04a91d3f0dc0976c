"""Token files against whole texts encoded at once."""

import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from cases import SCHEMA, documents, frame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratalens.llm import separators, token_orc
from stratalens.llm.queries import tokenizer_path
from stratalens.llm.shared import one_task_each
from stratalens.llm.word_tokens import LATIN, WordEncoder

END = 49407


def encoded(texts, as_text):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = as_text
    return [x.ids for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("as_text", [False, True])
def test_word_by_word_is_whole_text(as_text):
    draw = random.Random(1)
    letters = "aAbZéÉßİΣσς'’ \t\n .,!?;:<|endoftext|>123中文é가-\"s't "
    texts = ["".join(draw.choice(letters) for _ in range(30)) for _ in range(500)]
    texts += ["<|ENDOFTEXT|>.", "a<|endoftext|>b, it's It'S DON'T. x", "", " \n"]
    coder = WordEncoder(tokenizer_path(), as_text, most_words=50, most_cores=50)
    for _ in range(2):
        ids, counts = coder.ids(pa.array([*texts, None]))
        assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == [*encoded(texts, as_text), []]


def test_forms_of_a_word_share_one_entry():
    """Capitals and punctuation behind a Latin word are taken off before the lookup, so it is encoded and kept once."""
    forms = ["été", "Été", "ÉTÉ,", "été...", "Été?!", "house", "HOUSE;", "House.", "x1", "x1,", "İz", "漢字.", "Σς", "ΣΣ,", "'s"]
    coder, calls = WordEncoder(tokenizer_path(), False), []
    encode = coder._encode
    coder._encode = lambda cores: calls.extend(cores) or encode(cores)
    ids, counts = coder.ids(pa.array([" ".join(forms), "house ÉTÉ", None]))
    assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == [*encoded([" ".join(forms), "house ÉTÉ"], False), []]
    assert calls.count("été") == calls.count("house") == 1 and not {"Été", "ÉTÉ"} & set(calls)
    assert {"été", "house"} <= set(coder.words) and not {"Été", "ÉTÉ,", "House.", "HOUSE;"} & set(coder.words)


def test_latin_letters_are_the_same_to_arrow_and_the_tokenizer():
    words = [w for c in LATIN for w in (c, f"a{c}b,", f"{c}{c}.")]
    coder = WordEncoder(tokenizer_path(), False)
    ids, counts = coder.ids(pa.array(words))
    assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == encoded(words, False)
    assert len(coder.words) < len(words) * 2 / 3 and all(len(c.lower()) == 1 for c in LATIN)


def test_encoder_keeps_to_its_thread_and_little_memory():
    """A thread per core of the machine would add a heap each to a worker, which has one core; tables are bounded."""
    code = """
import os, re, sys, pyarrow as pa
from stratalens.llm.shared import free_memory
from stratalens.llm.word_tokens import WordEncoder
def held():
    free_memory()
    return int(re.search(r"Anonymous: +(\\d+)", open("/proc/self/smaps_rollup").read())[1]) >> 10
threads, coder = len(os.listdir("/proc/self/task")), WordEncoder(sys.argv[1], False, most_words=150_000, most_cores=50_000)
coder.ids(pa.array(["plain words"]))
mb = held()
for k in range(0, 400_000, 20_000):
    coder.ids(pa.array([" ".join(f"x{i}y-{i}" for i in range(k, k + 20_000))]))
print(len(os.listdir("/proc/self/task")) - threads, held() - mb)
"""
    run = subprocess.run([sys.executable, "-c", code, tokenizer_path()], capture_output=True, text=True, check=True, cwd=Path(token_orc.__file__).parents[2])
    threads, mb = map(int, run.stdout.split())
    assert threads == 0 and mb < 70


def test_offsets_of_files_need_no_python_worker(spark, tmp_path):
    path = str(tmp_path / "tokens")
    rows_sent = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    token_orc.write_tokens(frame(spark), path, tokenizer_path())
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == rows_sent
    plan = token_orc.read_tokens(spark, path)._jdf.queryExecution().analyzed().toString()
    assert "LocalRelation" in plan and "LogicalRDD" not in plan


def test_orc_round_trip(spark, tmp_path):
    rows = documents() + [documents()[3], (None, "null id", None, None, 1), (None, None, None, None, None)]
    path = str(tmp_path / "tokens")
    token_orc.write_tokens(frame(spark, rows, extra=["part", "ids", "before"]), path, tokenizer_path())
    got = token_orc.with_checksum(token_orc.read_tokens(spark, path)).orderBy("start").collect()
    assert len(got) == len(rows)
    ids = {}
    for row, x in zip(rows, encoded([r[1] for r in rows], False)):
        ids.setdefault(row[0], []).append([*x, 1])
    start = 0
    for r in got:
        fitting = [x for x in ids[r.doc_id] if zlib.crc32(np.array(x, "<u4").tobytes()) == r.ids_crc32]
        assert fitting and r.n_tokens == len(fitting[0]) and r.start == start
        ids[r.doc_id].remove(fitting[0])
        start += r.n_tokens
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))


def test_orc_lookup_is_pushed_down(spark, tmp_path):
    path = str(tmp_path / "tokens")
    token_orc.write_tokens(frame(spark), path, tokenizer_path())
    one = token_orc.token_files(spark, path).where("doc_id = 17")
    assert one.count() == 1
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,17)]" in one._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block_tokens", [7, 1 << 20])
def test_separator_scan(spark, tmp_path, block_tokens):
    rows = documents()
    names = separators.write_flat(frame(spark, rows, extra=["file", "ordinal"]).repartition(3), str(tmp_path), tokenizer_path(), END)
    if block_tokens == 7:
        rows = [r for r in rows if len(r[1] or "") < 3000]
        names = separators.write_flat(frame(spark, rows).repartition(3), str(tmp_path / "b"), tokenizer_path(), END)
    path = str(tmp_path / "b") if block_tokens == 7 else str(tmp_path)
    counts = separators.count_tokens(spark, path, names, END, block_tokens=block_tokens)
    got = {r.doc_id: r for r in names.join(counts, ["file", "ordinal"]).collect()}
    for row, ids in zip(rows, encoded([r[1] for r in rows], True)):
        assert got[row[0]].n_tokens == len(ids) + 1 and got[row[0]].complete
    by_file = {}
    for r in got.values():
        by_file.setdefault(r.file, []).append(r)
    for found in by_file.values():
        found.sort(key=lambda r: r.ordinal)
        assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1]]


def test_separator_scan_of_hand_made_files(spark, tmp_path):
    for name, ids in {"a.bin": [5, 9, 9, 1, 2, 9], "b.bin": [1, 2, 3], "c.bin": [], "d.bin": [9]}.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    files = spark.createDataFrame([(n,) for n in ("a.bin", "b.bin", "c.bin", "d.bin")], "file string")
    for block in (1, 2, 4):
        got = separators.count_tokens(spark, str(tmp_path), files, 9, block_tokens=block).orderBy("file", "ordinal").collect()
        assert [tuple(r) for r in got] == [
            ("a.bin", 0, 0, 2, True), ("a.bin", 1, 2, 1, True), ("a.bin", 2, 3, 3, True), ("b.bin", 0, 0, 3, False), ("d.bin", 0, 0, 1, True)]


def test_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    token_orc.write_tokens(empty, str(tmp_path / "orc"), tokenizer_path())
    assert token_orc.with_checksum(token_orc.read_tokens(spark, str(tmp_path / "orc"))).count() == 0
    names = separators.write_flat(empty, str(tmp_path / "flat"), tokenizer_path(), END)
    assert separators.count_tokens(spark, str(tmp_path / "flat"), names, END).count() == 0


def scanned(df):
    """How many rows the scan below a query gave out, from its metrics."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_orc_lookup_reads_few_rows(spark, tmp_path):
    path = str(tmp_path / "tokens")
    rows = [(2 * i, f"word {i}", None, None, 0) for i in range(24_000)]
    token_orc.write_tokens(frame(spark, rows), path, tokenizer_path())
    files = token_orc.token_files(spark, path)
    assert scanned(files) == len(rows)
    assert 0 < scanned(files.where("doc_id = 20000")) <= 1000
    # Odd ids lie inside the range of a row index, so only a Bloom filter can rule them out.
    assert sum(scanned(files.where(f"doc_id = {i}")) for i in range(10_001, 10_041, 2)) <= 2000


def test_blocks_are_scanned_by_many_tasks(spark, tmp_path):
    for n in range(40):
        (tmp_path / f"f{n}.bin").write_bytes(np.array([n + 100, 9, n + 100, n + 100, 9], "<u2").tobytes())
    files = spark.createDataFrame([(f"f{n}.bin",) for n in range(40)], "file string")
    assert one_task_each(files).rdd.getNumPartitions() == 40
    counts = separators.count_tokens(spark, str(tmp_path), files, 9, block_tokens=2)
    assert counts.where("complete").count() == 80
    # Tiny rows stay apart although adaptive execution puts small partitions together.
    seen = one_task_each(files).select(F.spark_partition_id().alias("p")).distinct().count()
    assert seen > 12
