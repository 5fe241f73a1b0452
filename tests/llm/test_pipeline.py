import corpus_pipeline
import pytest

from tickloom.llm import stages

from .conftest import DATA, prose
from .test_packing import check_rows
from .test_simhash import plain_components, plain_print


def test_stages_on_planted_rows(spark, docs):
    kept = {i: prose(i) for i in range(40)}
    near = prose(3).replace(" ", "  ", 2)
    rows = [*kept.items(), (100, kept[1]), (101, near), (102, None), (103, ""), (104, "short"), (105, "LOUD!! WORDS!! " * 60)]
    rows += [(106, prose(60) + " write to a.b@example.org or 4111 1111 1111 1111"), (107, " | ".join(prose(7).split()))]
    now = docs(rows)
    schema = now.schema
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, DATA)
        assert now.columns == schema.names, name
        now = spark.createDataFrame(now.collect(), schema)
        seen.append({r.doc_id: r.text for r in now.collect()})
    rules, quality, single, clean = seen
    assert rules.keys() >= kept.keys() and not rules.keys() & {102, 103, 104}
    assert quality.keys() >= kept.keys() and not quality.keys() & {105}
    assert not single.keys() & {100, 101} and single.keys() >= kept.keys()
    assert clean.keys() == single.keys()
    assert clean[106].endswith("write to [EMAIL] or [CARD]")
    assert all(clean[i] == kept[i] for i in kept)
    assert all(r.n_chars == len(r.text) for r in now.collect())


def test_near_copies_keep_one_of_equal_rows(spark, docs):
    base = prose(1)
    frame = docs([(5, base), (5, base), (None, base), (None, None), (None, ""), (9, prose(2))])
    left = stages.near_copies(spark, frame, DATA).collect()
    assert sorted((r.doc_id or 0, len(r.text or "")) for r in left) == [(0, 0), (5, len(base)), (9, len(prose(2)))]


def test_near_copies_against_all_pairs(spark, sample):
    rows = sorted((r.doc_id, r.text) for r in sample.collect())
    roots = plain_components([plain_print(t) for _, t in rows], 4)
    left = stages.near_copies(spark, sample, DATA)
    assert {r.doc_id for r in left.collect()} == {rows[i][0] for i in set(roots)}


def test_run_packs_what_is_left(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(stages.TOKENIZER)
    rows = corpus_pipeline.run(spark, DATA).collect()
    docs = {r.doc_id for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} < docs
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length, r.tier))
    for pieces in by_sequence.values():
        pieces.sort()
        assert pieces[0][0] == 0 and sum(p[1] for p in pieces) == pieces[0][2]


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_empty_tables(spark, docs, stage):
    assert stage(spark, docs([]), DATA).count() == 0


def test_packing_stage_round_trip(spark, sample):
    from tokenizers import Tokenizer
    from pyspark.sql import functions as F

    library = Tokenizer.from_file(stages.TOKENIZER)
    pieces = stages.packed(spark, sample, DATA).withColumn("ids_crc32", F.crc32("ids"))
    check_rows(pieces.collect(), {r.doc_id: r.text for r in sample.collect()}, library)
