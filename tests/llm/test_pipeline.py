"""The pipeline's stages, each on its own input, and the whole over a small folder of tables."""

import collections
import hashlib
import math
import random

import pytest

import corpus_pipeline
from helixmill.llm import line_dedup
from tests.llm.test_corpus import DOCS, components_by_brute_force, corpus, near_classes, prose, words_of


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(11)
    rows = corpus(spark, 80, 3)
    item = prose(rng, 30)
    rows += [(2000 + i, prose(rng, 80) + " " + item + " " + prose(rng, 10), "en", "src1", 1) for i in range(3)]
    insults = ["gormless", "nitwit", "blockhead", "dimwit"]
    marks = []
    for i in range(300):
        words = prose(rng, 60).split()
        for _ in range(4 if i % 3 == 0 else 0):
            words.insert(rng.randrange(len(words)), rng.choice(insults))
        rows.append((3000 + i, " ".join(words), "en", "src2", 1))
        marks.append((3000 + i, 1, int(i % 3 == 0)))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near dedup", "decontamination", "mixing"]
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "mixing":
            assert docs.columns == columns
        if name == "near dedup":
            assert kept[name] == set(near_classes(before.collect()).values())
    toxic = {3000 + i for i in range(0, 300, 3)}
    assert len(toxic & kept["toxicity"]) <= 3 and len(kept["toxicity"]) >= 280
    assert kept["line dedup"] == kept["toxicity"]
    assert not kept["decontamination"] & {2000, 2001, 2002}
    assert len(kept["decontamination"]) == len(kept["near dedup"] - {2000, 2001, 2002})


def test_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and {r.copy for r in rows} <= {1, 2, 3} and not {r.doc_id for r in rows} & {2000, 2001, 2002}


def lines_by_brute_force(rows):
    """(doc_id, text, source) without lines that are on too many of their source's pages."""
    pages, on = collections.Counter(r[2] for r in rows), collections.Counter()
    for _, text, source in rows:
        on.update((source, x) for x in {y.strip(" ") for y in (text or "").split("\n")} if x)
    bad = {k for k, n in on.items() if n >= line_dedup.LEAST and n > line_dedup.RATIO * pages[k[0]]}
    out = []
    for i, text, source in rows:
        kept = [x for x in (text or "").split("\n") if (source, x.strip(" ")) not in bad]
        whole = text is None or not any(x.strip(" ") for x in kept)
        out.append((i, text if whole else "\n".join(kept), source))
    return out


def one_of_each_by_brute_force(rows):
    texts = sorted({r[1] or "" for r in rows})
    part = dict(zip(texts, components_by_brute_force(texts), strict=True))
    best = {}
    for r in rows:
        key = r[0], hashlib.md5((r[1] or "").encode()).digest()
        if part[r[1] or ""] not in best or key < best[part[r[1] or ""]][0]:
            best[part[r[1] or ""]] = key, r
    return [r for _, r in best.values()]


def without_items_by_brute_force(rows, items):
    out = []
    for r in rows:
        words, found = words_of(r[1], True), False
        for item in items:
            w = words_of(item, True)
            size = min(5, len(w))
            runs = lambda x, n=size: {tuple(x[i : i + n]) for i in range(len(x) - n + 1)}
            found |= bool(w) and len(runs(w) & runs(words)) >= 0.8 * len(runs(w))
        if not found:
            out.append(r)
    return out


def mixed_by_brute_force(rows):
    """(doc_id, text, copy): the target mix, limited sources first, the rest by weight."""
    size = collections.Counter()
    for _, text, source in rows:
        size[source] += len(words_of(text))
    order = sorted(size, key=lambda x: (x is None, x or ""))
    weight, limited = {x: i % 3 + 1 for i, x in enumerate(order)}, set()
    while True:
        rest = sum(size.values()) - sum(3 * size[x] for x in limited)
        free = sum(weight[x] for x in order if x not in limited)
        more = {x for x in order if x not in limited and free and 3 * size[x] * free < rest * weight[x]}
        if not more:
            break
        limited |= more
    out = collections.Counter()
    for i, text, source in rows:
        target = 3 * size[source] if source in limited else rest * weight[source] / free
        rate = target / size[source] if size[source] else 0.0
        unit = int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:13], 16) / 2**52
        for copy in range(min(3, math.floor(rate) + (unit < rate - math.floor(rate)))):
            out[i, text, copy + 1] += 1
    return out


def test_run_by_brute_force(spark, folder):
    """The whole pipeline; only the toxicity decisions are the operator's own (see its tests)."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    calm = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, folder).collect()}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id in calm]
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = mixed_by_brute_force(without_items_by_brute_force(one_of_each_by_brute_force(lines_by_brute_force(rows)), items))
    got = collections.Counter((r.doc_id, r.text, r.copy) for r in corpus_pipeline.run(spark, folder).collect())
    assert got == want


def test_copies_of_a_third_of_a_source_leave_one(spark):
    rng = random.Random(23)
    families = ["\n".join(prose(rng, 12) for _ in range(4)) for _ in range(2)]
    texts = families * 10 + ["home | about\n" + prose(rng, 40) for _ in range(39)] + ["\n \n"]
    docs = spark.createDataFrame([(i, t, "en", "one", len(t)) for i, t in enumerate(texts)], DOCS)
    clean = corpus_pipeline.drop_boilerplate(spark, docs, "")
    cleaned = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    for i, t in enumerate(texts):
        want = t.removeprefix("home | about\n")
        assert cleaned[i] == (want, len(want))
    left = [r.text for r in corpus_pipeline.drop_near_duplicates(spark, clean, "").collect()]
    assert all(left.count(t) == 1 for t in families)
