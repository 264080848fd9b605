"""License scans against plain forms: phrases by hand, templates with words put in, left out and changed, odd rows."""

import re

import brute
from marketlake.llm import license_scan as L
from marketlake.llm import queries

HEADER = L.TEMPLATES[2][1]
GRANT = L.TEMPLATES[0][1]


def labels(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r["doc_id"]: r for r in L.license_labels(rows).collect()}


def plain_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(brute._LOWER))
    at = [(i, label) for phrase, label in L.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in at]
    return len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))


def test_base_of_tables_and_odd_rows(spark, sf_dir, odd_documents):
    for docs in (queries.documents(spark, sf_dir), odd_documents):
        want = sorted(repr((r["doc_id"], *plain_base(r["text"]))) for r in docs.select("doc_id", "text").collect())
        got = L.license_labels(docs).collect()
        assert sorted(repr(tuple(r)[:6]) for r in got) == want
        assert all(0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""} for r in got)


def test_phrases_at_borders_and_overlapping(spark):
    texts = ["MIT license", "mit mit license mit LICENSE", "submit license", "cc_by", "cc\n\n--by Ünïted", "gnu general public license apache license", "mit licensed", "CC BY cc by"]
    got = labels(spark, texts)
    assert [tuple(got[k])[1:6] for k in range(len(texts))] == [plain_base(t) for t in texts]


def test_notices_with_edits_are_found_and_parts_are_not(spark):
    words = GRANT.split()
    inserted = " ".join([*words[:30], "dear", "reader,", *words[30:]])
    dropped = " ".join(words[:20] + words[22:60] + words[61:])
    changed = " ".join("colour" if k == 40 else w for k, w in enumerate(words))
    texts = [
        f"some prose. {GRANT} more prose", inserted, dropped, changed, " ".join(words[:40]), " ".join(reversed(words)), f"{GRANT} {GRANT}",
        " ".join(f"{a} filler filler" for a in words), f"{HEADER}\n\n{GRANT}", "Released under the MIT licence", "free of charge to any person", "",
    ]
    got = labels(spark, texts)
    assert [got[k]["labels"] for k in range(len(texts))] == ["mit", "mit", "mit", "mit", "", "", "mit", "", "apache,mit", "mit", "", ""]
    assert got[0]["score"] == 1.0 and 0.8 <= got[1]["score"] <= 1 and 0.8 <= got[2]["score"] < 1 and 0.8 <= got[3]["score"] < 1 and got[4]["score"] == 0
    assert got[0]["n_base"] == 0 and got[8]["n_base"] == 1


def test_spans_tell_where(spark):
    docs = spark.createDataFrame([(1, "one two three " + GRANT + " four " + GRANT)] * 2 + [(1, "one two")], "doc_id long, text string")
    size = len(L.template_words(GRANT))
    got = sorted((r["start"], r["end"]) for r in L.template_spans(docs).collect())
    assert got == [(3, 3 + size), (4 + size, 4 + 2 * size)]


def test_only_hits_are_shuffled(spark, sf_dir, plan_of):
    """Words are spread and joined in the stage that reads the text, without Python."""
    plan = plan_of(L.license_labels(queries.documents(spark, sf_dir)))
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    spread = plan.index("Generate explode")
    assert "Exchange" not in plan[spread:].split("FileScan")[0]


def test_empty_table(no_documents):
    assert L.license_labels(no_documents).count() == 0
