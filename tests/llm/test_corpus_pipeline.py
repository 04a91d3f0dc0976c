"""The pipeline stage by stage against plain loops, and the registered queries against SQL."""

import hashlib
import re
import zlib
from pathlib import Path

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from cases import FOLDER, SCHEMA, documents, frame
from test_decontamination import brute as hits
from test_mixture import filled
from test_ngram_join import grouped, sets_of
from test_repetition import brute as repetition
from test_tokens import encoded

import __spark_entry__
from stratalens.llm import queries


def rules(text):
    f = repetition(text, 10)
    return f[0] >= 50 and 100 * f[4] <= 50 * f[0] and f[5] <= 0.4 * f[0] and f[6] <= 0.3 * f[0]


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
def test_stages(spark, tmp_path):
    rows = [r for r in documents() if len(r[1] or "") < 2500]
    items = [tuple(r) for r in spark.read.parquet(str(FOLDER / "benchmark.parquet")).collect()]
    docs, columns = frame(spark, rows), frame(spark, rows).columns
    for name, stage in corpus_pipeline.STAGES:
        before = rows
        stage(spark, docs, str(FOLDER)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "token_files":
            assert docs.columns == columns
            rows = sorted((tuple(r) for r in docs.collect()), key=str)
        if name == "quality":
            assert rows == sorted((r for r in before if rules(r[1])), key=str)
        elif name == "near_duplicates":
            group = grouped(sets_of(before))
            assert rows == sorted((r for r in before if group[r[0]][1] == r[0]), key=str)
        elif name == "decontamination":
            assert rows == sorted((r for r in before if not hits(r[1], items)[1]), key=str)
        elif name == "mixing":
            words = {r[0]: len(r[1].encode().split()) for r in before}
            size = {}
            for r in before:
                size[r[3]] = size.get(r[3], 0) + words[r[0]]
            want = filled(size)
            copies = []
            for r in before:
                number = int(hashlib.md5(f"{queries.MIX_SEED}|{r[0]}".encode()).hexdigest()[:13], 16) / 2**52
                rate = want[r[3]] / size[r[3]]
                copies += [r] * (int(rate) + (number < rate - int(rate)))
            assert rows == sorted(copies, key=str)
    start, got = 0, docs.orderBy("start").collect()
    rows.sort(key=lambda r: r[0])
    assert len(got) == len(rows)
    for r, row, ids in zip(got, rows, encoded([r[1] for r in rows], False)):
        crc = zlib.crc32(np.array([*ids, 1], "<u4").tobytes())
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (row[0], start, len(ids) + 1, crc)
        start += r.n_tokens


def test_awkward_rows_pass_through(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(None, text, None, None, None), (None, text, "a", "s", 1), (4, text, "a", None, 1), (4, text + " x", "b", "s", 2), (4, text, "a", None, 1), (9, None, None, None, None)]
    docs = frame(spark, rows, extra=["hits", "mix", "shard", "component_id"])
    for name, stage in corpus_pipeline.STAGES[:4]:
        stage(spark, docs, str(FOLDER)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "near_duplicates":
            assert sorted(str(r.doc_id) for r in docs.collect()) == ["4", "None", "None"]
    assert docs.count() > 0 and {r.mix for r in docs.collect()} == {"kept"}


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(FOLDER)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    result = con.execute(queries.SQL[name])
    names = [d[0] for d in result.description]
    got = queries.QUERIES[name](spark, str(FOLDER))
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(str, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(str, result.fetchall()))


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert not [p for p in Path(__spark_entry__.__file__).parent.glob("stratalens/**/*.py")
                if "llm" not in p.parts and re.search(r"\bllm\b", p.read_text())]
