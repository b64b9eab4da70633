import subprocess
import sys
from pathlib import Path

import corpus_pipeline as pipeline
import public_tokenizers
from tokenizers import Tokenizer

from loglake import session
from loglake.llm import jaccard_join, pii
from loglake.llm.queries import op2_toxicity


def test_each_stage_on_its_own_input(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    labels = spark.read.parquet(f"{small_dir}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}

    clean = pipeline.drop_toxic(spark, docs, small_dir)
    score = {r.doc_id: r.score for r in op2_toxicity.scores(docs, labels).collect()}
    assert {r.doc_id: r.text for r in clean.collect()} == {i: t for i, t in texts.items() if score[i] < 0.5}

    single = pipeline.one_of_each_group(spark, docs, small_dir)
    first = {r.component_id for r in jaccard_join.groups(docs).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(first)

    redacted = pipeline.redact(spark, docs, small_dir).collect()
    assert len(redacted) == len(texts)
    for r in redacted:
        assert not pii.base_spans(r.text) and (r.text == texts[r.doc_id] or pii.base_spans(texts[r.doc_id]) or "<" in r.text)

    for stage in (clean, single, pipeline.mix(spark, docs, small_dir)):
        assert tuple(stage.columns) == pipeline.COLUMNS


def test_one_row_of_each_group_also_without_ids(spark):
    """Near copies without an id leave one row, or the one with an id; empty rows stay unless repeated as a whole."""
    one, two = (" ".join(f"{w}{i}" for i in range(100)) for w in ("one", "two"))
    near = one.replace("one3 ", "far3 ")
    rows = [
        (None, one, "en", "a"), (None, near, "en", "a"), (5, two, "en", "a"), (5, two, "en", "b"),
        (None, two, "en", "c"), (None, None, "en", "a"), (None, None, "de", "a"), (None, None, None, "a"),
        (None, None, "a", None), (None, "", "en", "a"), (None, None, "en", "a"), (7, "", "en", "a"), (7, "", "en", "b"),
    ]
    docs = spark.createDataFrame([(*r, None) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = [tuple(r)[:4] for r in pipeline.one_of_each_group(spark, docs, None).collect()]
    assert sum(r[1] in (one, near) for r in got) == 1
    assert [r[0] for r in got if r[1] == two] == [5]
    assert sorted(map(str, (r for r in got if not r[1]))) == sorted({str(r) for r in rows if not r[1]})


def test_run_returns_what_the_stages_give_one_after_another(spark, small_dir):
    rows = pipeline.run(spark, small_dir).collect()
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, small_dir).collect(), docs.schema)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((r.doc_id, tuple(library.encode(r.text, add_special_tokens=False).ids)) for r in docs.collect())
    assert sorted((r.doc_id, tuple(memoryview(bytes(r.token_ids)).cast("I"))) for r in rows) == want


def test_stages_on_odd_rows(spark, odd, no_docs, small_dir):
    for docs in (odd, no_docs):
        for _, stage in pipeline.STAGES:
            docs = stage(spark, docs, small_dir)
        assert docs.count() >= 0


def test_texts_reach_python_once_and_in_small_batches(spark, small_dir, monkeypatch):
    seen = {}

    def recorded(rows, name):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        seen[name] = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")), plan
        return session.written(rows, name)

    monkeypatch.setattr(pipeline, "written", recorded)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    for stage in (pipeline.drop_toxic, pipeline.redact, pipeline.encode):
        stage(spark, docs, small_dir)
    assert [0 < rows <= pipeline.BATCH for rows, _ in seen.values()] == [True] * 3
    assert "_text" not in seen["harmless"][1]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_near_duplicates_leave_one_small_table(spark, small_dir):
    folder = Path(session.shared_folder(spark).removeprefix("file://"), "loglake")
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    before = set(folder.glob("**/*.parquet"))
    single = pipeline.one_of_each_group(spark, docs, small_dir)
    left = {f.parent for f in set(folder.glob("**/*.parquet")) - before}
    assert len(left) == 1 and left.pop().name.startswith("first-")
    assert single.count() == len({r.component_id for r in jaccard_join.groups(docs).collect()})


def test_freed_memory_goes_back_to_the_system():
    """Blocks that are freed beside ones that stay are given back, not only those at the heap's end."""
    code = """
from loglake.session import release_memory
def now(): return int(open("/proc/self/statm").read().split()[1]) * 4096 / 1e6
blocks = [bytearray(b"x" * 100_000) for _ in range(2000)]
kept = blocks[::20]
del blocks
held = now()
release_memory()
assert now() < held - 100, (held, now())
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(pipeline.__file__).parent)


def test_fits_are_followed_by_a_release(spark, small_dir, monkeypatch):
    done = []
    monkeypatch.setattr(pipeline, "release_memory", lambda: done.append(1))
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    pipeline.drop_toxic(spark, docs, small_dir)
    pipeline.redact(spark, docs, small_dir)
    assert len(done) == 2


def test_no_oracle_is_claimed():
    assert pipeline.ORACLE_SQL is None and len(pipeline.STAGES) == 5
