"""The pipeline's stages, each against what its operator says of the stage's own input."""

import random
from collections import Counter

from conftest import SF_SMALL
from edge import edge_docs, empty_docs, prose

import corpus_pipeline as P
from scorecast.llm import coordjoin, packing
from scorecast.llm.textops import words_of


def test_stages_on_given_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["language_id", "near_dedup", "pii", "mixing", "packing"]
    steps = [docs]
    for _, stage in P.STAGES[:-1]:
        steps.append(P.scratch(stage(spark, steps[-1], SF_SMALL), "test-stage"))
        assert steps[-1].columns == docs.columns
    rows = [[(r["doc_id"], r["text"], r["source"]) for r in s.collect()] for s in steps]
    assert len(rows[1]) >= 0.99 * len(rows[0])  # every document has a language here
    groups = coordjoin.brute_force([(d, t) for d, t, _ in rows[1]], round(100 * P.SIMILARITY))
    assert sorted(d for d, _, _ in rows[2]) == sorted(d for d, g in groups.items() if g[2])
    assert sorted(d for d, _, _ in rows[3]) == sorted(d for d, _, _ in rows[2])
    assert not any("@mail" in t for _, t, _ in rows[3])
    times = Counter(d for d, _, _ in rows[4])
    assert set(times) <= {d for d, _, _ in rows[3]} and max(times.values()) == 2
    total = [sum(len(words_of(t)) for _, t, _ in r) for r in rows]
    assert abs(total[4] - 1.5 * total[3]) <= 25
    pieces = P.pack(spark, steps[4], SF_SMALL).collect()
    assert sum(p["length"] for p in pieces) == sum(len(packing.ByteBpe.at(packing.tokenizer_path()).encode(t)) + 1 for _, t, _ in rows[4])


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    rows = [(11, prose(4, 30)), (11, prose(4, 30)), (11, "another text under that id"), (11, prose(5, 60)), (7, prose(5, 60)), (9, prose(6, 60) + " end"),
            (8, prose(6, 60)), (3, None), (3, ""), (None, prose(4, 30))]
    out = P.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF_SMALL)
    assert Counter(map(tuple, out.collect())) == Counter([(11, prose(4, 30)), (11, "another text under that id"), (7, prose(5, 60)), (8, prose(6, 60)),
                                                          (3, None), (3, ""), (None, prose(4, 30))])


def test_unlearned_languages_and_gibberish_go(spark):
    r = random.Random(3)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    total = docs.count()
    finnish = ("kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto "
               "ja heidän on toimittava toisiaan kohtaan veljeyden hengessä ").split()
    greek = "όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα είναι προικισμένοι με λογική και συνείδηση".split()

    def planted(words, n):
        return " ".join(r.choice(words) for _ in range(n))

    noise = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(400)]
    rows = [(10**9 + i, planted(w, n)) for i, (w, n) in enumerate([(finnish, 300), (greek, 300), (noise, 60), (noise, 300), (noise, 3000)])]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    out = P.language_id(spark, docs.unionByName(more, allowMissingColumns=True), SF_SMALL)
    ids = {x["doc_id"] for x in out.collect()}
    assert not [i for i, _ in rows if i in ids]
    assert len(ids) >= 0.99 * total


def test_packed_sequences_can_be_rebuilt(spark):
    texts = ["One text. " * 300, "one text, shorter", "another copy"]
    docs = spark.createDataFrame([(7, t, "en") for t in texts], "doc_id long, text string, lang string").coalesce(1)
    bpe = packing.ByteBpe.at(packing.tokenizer_path())
    rows = sorted(P.pack(spark, docs, SF_SMALL).collect(), key=lambda r: (r["sequence_id"], r["offset"]))
    stream = [i for r in rows for i in r["ids"]]
    assert sorted(stream) == sorted(i for t in texts for i in [*bpe.encode(t).tolist(), packing.CLOSING_ID])
    assert all(len(r["ids"]) == r["length"] for r in rows)


def test_run_is_registered(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is P.run
    assert P.run(spark, SF_SMALL).count() > 0


def test_edges(spark):
    for docs in (edge_docs(spark), empty_docs(spark)):
        for name, stage in P.STAGES:
            out = P.scratch(stage(spark, docs, SF_SMALL), "test-edge")
            if name != "packing":
                assert out.columns == docs.columns, name
                docs = out
        assert out.columns[0] == "doc_id"
    kept = {r["doc_id"] for r in P.near_dedup(spark, edge_docs(spark), SF_SMALL).collect()}
    assert {1, 11} <= kept and not {2, 3, 13} & kept
    gone = {r["doc_id"] for r in edge_docs(spark).collect()} - {r["doc_id"] for r in P.language_id(spark, edge_docs(spark), SF_SMALL).collect()}
    assert gone == {5, 6, 7, 8}
