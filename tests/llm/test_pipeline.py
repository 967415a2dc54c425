"""The pipeline against the same stages done by brute force."""

import hashlib

import numpy as np
import pytest
import tiktoken

import corpus_pipeline
from tests.llm.test_models import direct_quality
from tests.llm.test_operators import FOLDER, WORD, brute_mix, brute_print
from tidewright.llm import bpe, common, simhash
from tidewright.llm.common import table


def test_run_leaves_only_the_stages_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "scratch", lambda spark: str(tmp_path))
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
    assert {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()} == {f"pipeline-{name}" for name, _ in corpus_pipeline.STAGES}


def test_results_of_others_outlive_a_run(spark):
    lazy = simhash.drop_near_copies(table(spark, FOLDER, "documents"))
    assert corpus_pipeline.run(spark, FOLDER).count() > 0 and lazy.count() > 0


class Session:
    """What scratch reads of a session."""

    def __init__(self, master, folder):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-" + master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: folder)})


def test_a_cluster_needs_a_shared_folder():
    assert common.scratch(Session("yarn", "s3a://b/c/")) == "s3a://b/c"
    assert common.scratch(Session("local[2]", None)) == common.scratch(Session("local[2]", None))
    for master in ("yarn", "spark://h:7077", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            common.scratch(Session(master, None))


def test_empty_tables_and_clashing_columns(spark, tmp_path):
    """Nulls, empty and repeated texts, columns with the names used inside, and no rows at all, through all stages."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp string, __id string, digest string, size string, part string, k string, row string"
    rest = (None, None, None, "f", "i", "d", "s", "p", "k", "r")
    rows = [(None, None, *rest), (None, "", *rest), (1, "a b c d e f", *rest), (1, "a b c d e f", *rest), (2, "ü" * 20_000, *rest), (3, "one two three", "en", "s", 13, *rest[3:])]
    for name, data in (("some", rows), ("none", [])):
        folder = tmp_path / name
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (None, None, None)] if data else [], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        docs = table(spark, str(folder), "documents")
        for stage, (at, f) in enumerate(corpus_pipeline.STAGES):
            out = f(spark, docs, str(folder))
            assert at == "bpe" or out.columns == docs.columns
            out.write.parquet(f"{folder}/{at}")
            docs = spark.read.schema(out.schema).parquet(f"{folder}/{at}")
            assert docs.count() == ([6, 4, 4, 5, 5][stage] if data else 0), at


def test_stages(spark):
    docs = table(spark, FOLDER, "documents")
    frames = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        frames[name] = docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), stage(spark, docs, FOLDER).schema)
        assert name == "bpe" or docs.columns == frames[""].columns
    before, after = frames["quality"].collect(), frames["exact_dedup"].collect()
    given = [(r.doc_id, r.text) for r in frames[""].collect()]
    scores = direct_quality(spark, given, [(r.doc_id, r.quality) for r in table(spark, FOLDER, "labels").collect()])
    assert sorted(r.doc_id for r in before) == sorted(i for i, t in given if scores[t or ""] >= 0.3) and len(before) < len(given)
    norm = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    best = {}
    for r in before:
        k = norm(r.text)
        best[k] = min(best.get(k, (1, 0)), (-len(r.text or ""), r.doc_id))
    assert {r.doc_id for r in after} == {i for _, i in best.values()}
    prints = {r.doc_id: brute_print(r.text) for r in after}
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    near = frames["near_dedup"].collect()
    assert {r.doc_id for r in near} == {root(i) for i in ids}
    mix = frames["mixing"].collect()
    assert {r.doc_id for r in mix} <= {r.doc_id for r in near}
    taken = {i: 0 for i in prints}
    for r in mix:
        taken[r.doc_id] += len(WORD.findall(r.text or ""))
    want = {int(i): n for i, _, _, _, n in brute_mix([(r.doc_id, r.text, r.source) for r in near])}
    assert {i: n for i, n in taken.items() if n} == {i: n for i, n in want.items() if n}
    texts = {r.doc_id: WORD.findall(r.text or "") for r in near}
    for r in mix:  # whole texts, or a run of words that may go on at the beginning
        twice = texts[r.doc_id] * 2
        assert " " + " ".join(WORD.findall(r.text or "")) + " " in " " + " ".join(twice) + " "
    path, pattern = bpe.public_vocabulary()
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.ranks(path), special_tokens={})
    want = sorted((r.doc_id, hashlib.sha256(np.array(own.encode_ordinary(r.text or ""), "<u4").tobytes()).hexdigest()) for r in mix)
    assert sorted((r.doc_id, r.ids_sha256) for r in frames["bpe"].collect()) == want
