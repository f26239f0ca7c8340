"""The pipeline on a small corpus: every stage beside a plain version of its rule."""

import random
import re

import pytest

import corpus_pipeline
from grainmill.llm import common

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rnd = random.Random(12)
    vocabulary = ["".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(rnd.choice([1, 2, 3, 4]))) for _ in range(4000)]
    prose = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(prose(30))) for k in range(12)]
    rows, kind, group = [], {}, {}
    for i in range(400):
        what = rnd.choice(["clean"] * 6 + ["junk", "copy", "leak", "data"])
        words = prose(rnd.choice([40, 150, 400]))
        if what == "copy" and any(k == "clean" for k in kind.values()):
            of = rnd.choice([j for j, k in kind.items() if k == "clean"])
            words = rows[of][1].split(" ")
            for _ in range(len(words) // 60):
                words[rnd.randrange(len(words))] = "changed"
            group[i] = of
        elif what == "copy":
            what = "clean"
        if what == "junk":
            words = [w + "###" for w in words]
        if what == "leak":
            words[7:7] = items[rnd.randrange(12)][1].split(" ")
        if what == "data":
            words.insert(5, f"user{i}@mail.example.com")
        kind[i] = what
        rows.append((i, " ".join(words), "en", f"s{i % 3}", 0))
    rows = [(*r[:4], len(r[1])) for r in rows] + [(400, None, None, None, None), (401, "", "en", "s0", 0), (None, " ".join(prose(50)), "en", "s1", 5)]
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows, kind, group


def test_stages(spark, corpus):
    folder, rows, kind, group = corpus
    docs = common.table(spark, folder, "documents")
    columns = docs.columns
    seen = []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = common.stored(stage(spark, docs, folder), f"stage-{n}")
        seen.append(docs)
        if n < 4:
            assert docs.columns == columns, name
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in seen]
    everything = {r[0] for r in rows}
    assert ids[0] == {i for i in everything if i is None or kind.get(i, "junk") != "junk"}
    assert ids[1] == {i for i in ids[0] if i not in group}
    assert ids[2] == {i for i in ids[1] if kind.get(i) != "leak"} == ids[3]
    text = {r[0]: r[1] for r in rows}
    for r in seen[3].collect():
        if kind.get(r.doc_id) == "data":
            assert f"user{r.doc_id}@" not in r.text and r.n_chars == len(r.text)
            assert [w for w in r.text.split(" ") if "@" not in w] == [w for w in text[r.doc_id].split(" ") if "@" not in w]
        else:
            assert r.text == text[r.doc_id]
    before = {r.doc_id: len(WORD.findall(r.text)) for r in seen[3].collect()}
    taken = {}
    for r in seen[4].collect():
        assert len(WORD.findall(r.text)) == r.taken == len(r.text.split(" ")) <= 3 * before[r.doc_id] and r.size == before[r.doc_id]
        taken[r.source] = (taken.get(r.source, (0, 0))[0] + r.taken, r.target)
    assert all(abs(a - b) <= 48 for a, b in taken.values())


def test_registered(spark, corpus):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()
    assert corpus_pipeline.run(spark, corpus[0]).count() > 100
