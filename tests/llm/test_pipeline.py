"""The corpus pipeline: each stage on what the one before kept."""

import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from helpers import documents
from ledgerloom.llm import queries, simhash, toxicity
from ledgerloom.llm.common import read
from test_packing import check

SF = "/root/testdata/sf0.01"


def test_registered():
    names = entry.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(entry.oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "language ID", "SimHash near-dedup", "secret scans", "packing"]


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = read(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF).cache()
        out.append((name, docs, kept))
        docs = kept
    return out


def test_columns(steps):
    for name, docs, kept in steps[:-1]:
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes, name


def test_toxic_documents_go(spark, steps):
    _, docs, kept = steps[0]
    bad = {r["doc_id"] for r in toxicity.score(docs, read(spark, SF, "labels")).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - bad and bad


def test_clean_documents_have_a_language(steps):
    _, docs, kept = steps[1]
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, docs.collect()))


def test_one_of_each_group_stays(spark, steps):
    _, docs, kept = steps[2]
    groups = {r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(groups) and len(groups) < docs.count()


def test_secrets_are_masked_and_counted(steps):
    _, docs, kept = steps[3]
    before, after = ({r["doc_id"]: r for r in x.collect()} for x in (docs, kept))
    assert set(before) == set(after)
    for i, r in after.items():
        assert r["text"] == re.sub(r'(?i)(token = ")[0-9a-f]{40}"', r'\1[SECRET]"', before[i]["text"]) and r["n_chars"] == len(r["text"])


def test_everything_kept_is_packed(steps):
    _, docs, pieces = steps[4]
    assert check(pieces.collect(), {r["doc_id"]: r["text"] for r in docs.collect()}) < 0.02


def test_odd_documents_pass_every_stage(spark):
    frame = documents(spark, [(1, None), (2, ""), (None, "the and of to"), (None, "the and of to"), (3, "the same " * 40, None, None),
                              (4, "the same " * 40, "en", "s"), (5, "plain words of a text here", "de", None)])
    frame = frame.select("doc_id", "text", "lang", "source", "n_chars")
    docs = frame
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        assert stage(spark, frame.where("false"), SF).count() == 0, name
    assert docs.count() > 0


PROSE = {"en": "the cat sat with that thing and they went there together for this weather because nothing else was open",
         "de": "der hund und die katze sind nicht schlecht aber auch zwischen durch gegen viele andere tiere im garten"}


def test_each_row_has_its_own_verdict(spark):
    rows = [(None, PROSE["en"], "en", None), (None, PROSE["de"], "de", None), (None, "", "en", None), (None, "123 !!", "en", None),
            (7, PROSE["de"], "de", None), (7, PROSE["en"], "en", None), (7, None, "en", None)]
    frame = documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    kept = corpus_pipeline.drop_unknown_language(spark, frame, SF).collect()
    assert sorted((str(r["doc_id"]), r["lang"], r["text"]) for r in kept) == sorted(
        (str(i), lang, PROSE[lang]) for i in (None, 7) for lang in ("en", "de"))


def test_copies_are_told_by_text_not_by_id(spark):
    other = "completely different words stand in this line so that it is no copy of anything else here"
    rows = [(None, PROSE["en"]), (None, PROSE["en"]), (None, other), (None, other), (5, PROSE["en"]), (7, PROSE["de"]),
            (7, PROSE["en"]), (3, PROSE["de"].upper()), (7, "a third text of the same id that nobody else has written at all")]
    frame = documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    kept = corpus_pipeline.drop_near_copies(spark, frame, SF).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == sorted(
        [("None", other), ("5", PROSE["en"]), ("3", PROSE["de"].upper()), ("7", rows[-1][1])])
