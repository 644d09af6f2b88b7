"""The corpus operators against brute force, on small hostile tables."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixmill.llm import dart_minhash, decontamination, elias_fano, license_scan, line_dedup, mixing, ngram_lm, order_minhash, queries, substring_dedup, toxicity, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in is it on as at by for be or was this that from with are".split()


def prose(rng, n):
    return " ".join("".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3))) for _ in range(n))


def corpus(spark, n=60, seed=1):
    """Prose, copies, near copies, repeated passages and lines, odd and missing values."""
    rng = random.Random(seed)
    passage = prose(rng, 60)
    rows = []
    for i in range(n):
        text = prose(rng, rng.choice([3, 40, 120, 300]))
        if i % 7 == 0 and i:
            text = rows[i // 2][1]
        elif i % 7 == 1 and i > 1:
            words = (rows[i - 2][1] or "").split()
            if words:
                words[len(words) // 2] = "edited"
            text = " ".join(words)
        elif i % 7 == 2:
            text = text + "\n" + passage + "\n" + prose(rng, 20)
        elif i % 7 == 3:
            text = "Shared line of the site.\n" + text
        rows.append((i * 3, text, "en", f"src{i % 3}", len(text)))
    rows += [(1000, None, None, None, None), (1001, "", "en", "src0", 0), (1002, "  \n\t ", "en", None, 5), (1003, "é ça ÀB", "fr", "src1", 7), (1004, "\U0001f600 " * 50, "xx", "src1", 100)]
    rows += [rows[5], rows[5], (1005, prose(rng, 9000), "en", "src2", 1)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(spark), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words_of(text, lower=False):
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def test_substring_dedup(docs, empty):
    rows = docs.collect()
    counts = collections.Counter(tuple(w[i : i + 35]) for r in rows for w in [words_of(r.text)] for i in range(len(w) - 34))
    want = collections.Counter()
    for r in rows:
        w = words_of(r.text)
        gone = {j for i in range(len(w) - 34) if counts[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        want[r.doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    assert collections.Counter(map(tuple, substring_dedup.without_repeats(docs, with_text=False).collect())) == want
    assert any(k[2] for k in want)
    assert substring_dedup.without_repeats(empty).count() == 0


def near_classes(rows):
    sets = {r.doc_id: collections.Counter(tuple(w[i : i + 5]) for w in [words_of(r.text, True)] for i in range(max(1, len(w) - 4)) if w) for r in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    text = {r.doc_id: r.text or "" for r in rows}
    for a, b in itertools.combinations(sorted(sets), 2):
        both = sum((sets[a] & sets[b]).values())
        total = sum(sets[a].values()) + sum(sets[b].values()) - both
        if text[a] == text[b] or (total and both / total >= 0.8):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: find(i) for i in sets}


def test_near_duplicates(docs, empty):
    want = near_classes(docs.collect())
    got = dart_minhash.near_duplicates(docs).collect()
    assert len(got) == docs.count() and {r.doc_id: r.class_id for r in got} == want
    assert dart_minhash.near_duplicates(empty).count() == 0
    kept = dart_minhash.deduplicated(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values())) and kept.columns == docs.columns


def test_near_duplicates_large_group(spark):
    rng = random.Random(4)
    base = prose(rng, 100).split()
    rows = []
    for i in range(700):  # more than one lot, all alike to each other
        w = list(base)
        w[rng.randrange(100)] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, prose(rng, 80)) for i in range(50)]
    got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == 0 for i in range(700)) and all(got[i] == i for i in range(1000, 1050))


def components_by_brute_force(texts, size=5, threshold=0.8):
    """The least index of each text's component over all pairs of weighted Jaccard."""
    grams = []
    for t in texts:
        w = words_of(t, True)
        grams.append(collections.Counter(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else collections.Counter())
    least = list(range(len(texts)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        both = sum((grams[i] & grams[j]).values())
        if texts[i] == texts[j] or (both and both >= threshold * (sum(grams[i].values()) + sum(grams[j].values()) - both)):
            a, b = sorted((root(i), root(j)))
            least[b] = a
    return [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("seed", [1])
def test_family_around_the_threshold(spark, seed):
    """Copies of copies with one to ten edits: most pairs are a little above or below 0.8."""
    rng = random.Random(seed)
    base, texts = prose(rng, 120).split(), []
    for i in range(260):
        words = list(base if i < 40 or rng.random() < 0.5 else texts[rng.randrange(len(texts))].split())
        for _ in range(rng.randint(1, 8)):
            at, kind = rng.randrange(len(words)), rng.random()
            words[at : at + (kind > 0.1)] = [f"edit{rng.randrange(40)}"] if kind < 0.9 else []
        texts.append(" ".join(words))
    want = components_by_brute_force(texts)
    assert 3 < len(set(want)) < 250
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicates(df).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_repeated_ids_lose_no_text(spark):
    rng = random.Random(5)
    one, two = prose(rng, 40), prose(rng, 40)
    rows = [(3, one, 1), (5, one, 2), (5, two, 3), (5, two, 3), (9, two, 4), (9, "alone", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __key int")
    got = sorted((r.doc_id, r.class_id) for r in dart_minhash.near_duplicates(df).collect())
    assert got == [(3, 3), (5, 3), (5, 5), (5, 5), (9, 5), (9, 9)]
    kept = dart_minhash.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect())) == [(3, one, 1), (5, two, 3), (9, "alone", 5)]


def test_null_ids_are_alone(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (8, "a b c d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(str, (r.class_id for r in dart_minhash.near_duplicates(df).collect()))) == ["7", "7", "None", "None"]
    assert sorted(str(r.doc_id) for r in dart_minhash.deduplicated(df).collect()) == ["7", "None", "None"]


def test_signatures_estimate_weighted_jaccard():
    from helixmill.llm.shared import words_of as tokens
    import pyarrow as pa

    a, b = "a b c d e f g h " * 40 + "p q r s " * 30, "a b c d e f g h " * 55
    _, t = next(iter(tokens(pa.array([a, b]))))
    sig, used = dart_minhash.signatures(t, 1, 2000)
    ca, cb = collections.Counter(a.split()), collections.Counter(b.split())
    both = sum((ca & cb).values())
    assert used.all() and abs((sig[0] == sig[1]).mean() - both / (sum(ca.values()) + sum(cb.values()) - both)) < 0.05


def test_decontamination(spark, docs, empty):
    rows = docs.collect()
    rng = random.Random(9)
    pool = [r for r in rows if len(words_of(r.text)) > 100]
    items = [(i, " ".join(pool[i % len(pool)].text.split()[20:50])) for i in range(8)]
    items += [(20, prose(rng, 30)), (21, None), (22, ""), (23, " ".join(pool[0].text.split()[3:6])), (24, items[0][1] + " " + prose(rng, 5)), (0, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def grams(words, n=5):
        return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()

    want = collections.Counter()
    for r in rows:
        w = words_of(r.text, True)
        for i, t in set(items):
            v = words_of(t, True)
            g = grams(v)
            if g and w:
                c = len(g & grams(w, min(5, len(v)))) / len(g)
                if c >= 0.8:
                    want[r.doc_id, i, len(g), c] += 1
    assert collections.Counter(map(tuple, decontamination.leaks(docs, bench).collect())) == want and want
    assert collections.Counter(map(tuple, decontamination.leaks(docs, bench, block=3).collect())) == want
    clean = decontamination.clean(docs, bench)
    bad = {k[0] for k in want}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in rows if r.doc_id not in bad) and clean.columns == docs.columns
    assert decontamination.leaks(empty, bench).count() == 0 and decontamination.clean(docs, bench.limit(0)).count() == len(rows)


def test_line_dedup(docs, empty):
    rows = docs.collect()
    pages, lines = collections.Counter(r.source for r in rows), collections.Counter()
    for r in rows:
        for x in {x.strip(" ") for x in (r.text or "").split("\n")} - {""}:
            lines[r.source, x] += 1
    bad = {k for k, n in lines.items() if n >= 3 and n > 0.1 * pages[k[0]]}
    want = collections.Counter()
    for r in rows:
        cut = None if r.text is None else [x for x in r.text.split("\n") if (r.source, x.strip(" ")) not in bad]
        n = 0 if cut is None else len(r.text.split("\n"))
        want[r.doc_id, None if cut is None else "\n".join(cut), n, 0 if cut is None else n - len(cut)] += 1
    got = line_dedup.without_boilerplate(docs, ratio=0.1, least=3).select("doc_id", "text", "__n_lines", "__n_dropped")
    assert collections.Counter(map(tuple, got.collect())) == want and any(k[3] for k in want)
    assert line_dedup.without_boilerplate(empty).count() == 0


def test_mixing(docs, empty):
    rows = docs.collect()
    size = collections.Counter()
    for r in rows:
        size[r.source] += len(words_of(r.text))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    capped = set()
    while True:  # the rule as it is told: share, cap, share the excess
        rest, free = sum(size.values()) - sum(3 * size[s] for s in capped), sum(weight[s] for s in order if s not in capped)
        more = {s for s in order if s not in capped and 3 * size[s] < rest * weight[s] / free}
        if not more:
            break
        capped |= more
    target = {s: 3 * size[s] if s in capped else rest * weight[s] / free for s in order}
    got = mixing.with_copies(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["__source_size"] == size[r.source] and math.isclose(r["__target"], target[r.source], abs_tol=1e-6)
        rate = target[r.source] / size[r.source] if size[r.source] else 0
        assert math.floor(rate - 1e-9) <= r["__copies"] <= min(3, math.ceil(rate + 1e-9))
    again = mixing.with_copies(docs).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mixed(docs).count() == sum(r["__copies"] for r in got)
    assert mixing.mixed(empty).count() == 0 and mixing.with_copies(docs.filter("text is null")).first()["__copies"] == 0


def test_order_minhash(docs, empty):
    tied = docs.withColumn("tie", F.xxhash64("text")).collect()
    rows = sorted(tied, key=lambda r: (-r.doc_id, r.tie, r.text or ""))
    got = collections.Counter(tuple(r)[:3] for r in order_minhash.with_next(docs, 4000, 3).collect())
    want, prints = collections.Counter(), {}
    for i, r in enumerate(rows):
        text, after = r.text or "", rows[(i + 1) % len(rows)].text or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        want[r.doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert got == want
    for r in order_minhash.with_next(docs).collect():
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert order_minhash.with_next(empty).count() == 0
    one = docs.limit(0).unionByName(docs.filter("doc_id = 9"))
    assert [(r.near_next, r.n_chars) for r in order_minhash.with_next(one).collect()] == [(1.0, len(docs.filter("doc_id = 9").first().text))]


def test_order_minhash_shuffles_texts_once(docs):
    """Both readers of the ranges share one exchange, and with it the ranges' bounds."""
    out = order_minhash.with_next(docs)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    ranges = [x for x in plan.splitlines() if "rangepartitioning" in x]
    assert "ReusedExchange" in plan and sum("ReusedExchange" not in x for x in ranges) <= 2


def test_order_minhash_of_null_and_equal_ids(spark):
    rows = [(None, "abcdefghijkl", "x"), (None, None, "x"), (4, "mnopqrstuvwxyz", "y"), (4, "mnopqrstuvwxyz", "y"), (4, "0123456789", "y")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, tie string")
    order = df.withColumn("hash", F.xxhash64("text")).collect()
    order.sort(key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.hash, r.text or ""))
    want = collections.Counter()
    for i, r in enumerate(order):
        text, after = r.text or "", order[(i + 1) % len(order)].text or ""
        cut = len(text) // 3
        want[r.doc_id, hashlib.sha256((text[: len(text) - cut] + after[:cut]).encode()).hexdigest()] += 1
    for ranges in (1, 2, 7):
        assert collections.Counter((r.doc_id, r.edited_sha256) for r in order_minhash.with_next(df, least_ranges=ranges).collect()) == want


def brute_sketch(text, k=9, bins=64, take=2):
    """Order MinHash from its definition, with the same hash."""
    p = order_minhash.points(text)
    n = max(1, len(p) - k + 1) if len(p) else 0
    h, seen, lots = [], collections.Counter(), collections.defaultdict(list)
    for i in range(n):
        x = 0
        for c in p[i : i + k].tolist() if len(p) >= k else p.tolist():
            x = (x * 0x9E3779B97F4A7C15 + c + 1) % 2**64
        h.append(int(order_minhash.mix(np.array([x], np.uint64))[0]))
    for i, x in enumerate(h):
        m = seen[x]
        seen[x] += 1
        y = int(order_minhash.mix(np.array([(x + m * 0xD6E8FEB86659FD93) % 2**64], np.uint64))[0]) if m else x
        lots[y >> 58].append((y, i))
    out = np.zeros(bins, np.uint32)
    for lot, found in lots.items():
        chain = 0
        for y, _ in sorted(sorted(found)[:take], key=lambda f: f[1]):
            chain = int(order_minhash.mix(np.array([(chain * 0x2545F4914F6CDD1D + y) % 2**64], np.uint64))[0])
        out[lot] = (chain >> 32) | 1
    return out


def test_sketch_by_definition():
    rng = random.Random(3)
    for text in ("", "a", "abcdefghi", "ab" * 60, prose(rng, 60), "é" * 30 + prose(rng, 20)):
        assert (order_minhash.sketch(order_minhash.points(text)) == brute_sketch(text)).all()
    text = prose(rng, 400)
    half = len(text) // 2
    like = lambda a, b: order_minhash.likeness(*[order_minhash.sketch(order_minhash.points(x)) for x in (a, b)])
    assert like(text, text) == 1 and like(text, text[:-20]) > 0.8 > like(text, text[half:] + text[:half]) > like(text, prose(rng, 400))


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize("shard", [1 << 21, 300])
def test_language_model(docs, empty, order, shard, monkeypatch):
    monkeypatch.setattr(ngram_lm, "SHARD_WORDS", shard)
    rows = docs.collect()
    train = lambda i: zlib.crc32(str(i).encode()) % 5 != 1
    c = collections.Counter(w for r in rows if train(r.doc_id) for w in [*words_of(r.text, True), "end"])
    n, v = sum(c.values()), len(c)
    grams, contexts, kinds = collections.Counter(), collections.Counter(), collections.Counter()
    line = lambda r: ["begin"] * (order - 1) + words_of(r.text, True) + ["end"]
    for r in rows:
        s = line(r)
        for k, i in itertools.product(range(2, order + 1), range(order - 1, len(s))):
            if train(r.doc_id):
                g = tuple(s[i - k + 1 : i + 1])
                kinds[g[:-1]] += not grams[g]
                grams[g] += 1
                contexts[g[:-1]] += 1
    want = {}
    for r in rows:
        s, base, score = line(r), 0.0, 0.0
        for i in range(order - 1, len(s)):
            p = (c[s[i]] + 0.5) / (n + 0.5 * (v + 1))
            base += math.log10(p)
            for k in range(2, order + 1):
                g = tuple(s[i - k + 1 : i + 1])
                if contexts[g[:-1]]:
                    p = max(grams[g] - 0.4, 0) / contexts[g[:-1]] + 0.4 * kinds[g[:-1]] / contexts[g[:-1]] * p
            score += math.log10(p)
        want[r.doc_id] = len(s) - order + 1, sum(c[w] > 0 for w in s[order - 1 :]), n, base, score
    rule = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    got = ngram_lm.scored(docs, rule, order=order).collect()
    assert len(got) == len(rows)
    for r in got:
        w = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == w[:3] and math.isclose(r.base_score, w[3], rel_tol=1e-9)
        assert abs(r.score - w[4]) <= 0.02 * r.n_tokens * order  # half a step of the bytes for each look-up
    assert ngram_lm.scored(empty, rule).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n, u in ((0, 10), (1, 1), (5, 3), (1000, 10), (1000, 2**40), (5000, 2**62), (3000, 3001)):
        v = np.sort(rng.integers(0, u, n).astype(np.uint64))
        e = elias_fano.EliasFano(v)
        q = np.concatenate((v, v + np.uint64(1), np.array([0, 2**63], np.uint64)))
        assert (e.get(np.arange(n)) == v).all() and (e.successor(q) == np.searchsorted(v, q)).all()
    v = np.sort(rng.integers(0, 2**40, 20000).astype(np.uint64))
    e = elias_fano.EliasFano(v)
    assert e.low.nbytes + e.high.nbytes < 0.5 * v.nbytes


@pytest.mark.parametrize("total", [10**3, 10**10, 10**15])
def test_rare_followers_of_frequent_contexts_keep_their_probability(total):
    """A context's probabilities and its backoff weight sum to 1 but for the bytes' steps."""
    kinds = min(total // 20, 100_000)
    counts = np.ones(kinds, np.int64)
    counts[0] = total - kinds + 1
    floor = elias_fano.floor_of(total, 0.4)
    trie = elias_fano.Trie(np.array([7], np.uint64), np.array([total]), [(np.zeros(kinds, np.int64), np.arange(kinds, dtype=np.uint32), counts)], 0.4, floor)
    values = elias_fano.values_of(floor)
    step = 10 ** (-floor / elias_fano.QUANTA / 2)
    assert 1 / step <= values[np.asarray(trie.codes[0])].sum() + values[np.asarray(trie.backoffs[0])].sum() <= step
    rare = values[np.asarray(trie.codes[0])[1]]
    assert 1 / step <= rare / (0.6 / total) <= step


def test_url_rules_in_any_spelling(spark):
    pages = spark.createDataFrame([(1, "http://a.COM/en/1"), (2, "http://b.org/x"), (3, "http://c.com/" + "y" * 300_000)], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judged(pages, [url_filter.Rule("COM", "/en/", "block"), url_filter.Rule("B.Org", "", "block")]).collect()}
    assert got == {1: ("com/en/", "block"), 2: ("b.org", "block"), 3: (None, "allow")}
    assert url_filter.judged(pages.limit(0), [url_filter.Rule("COM", "/en/", "block")]).count() == 0


def test_url_filter(spark):
    urls = ["http://A.Example.COM/en/7x?q", "https://b.com/en/1", "ftp://x.net", "no scheme /en/", None, "", "http://com/en/", "http://notcom/en/", "http://q.net/de/8#f", "http://spam.org:80/es/", "http://bad-site.info/", "a://b://c/en/", "http://?x", "http://e.com/en/7\n8"]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(1, urls[1])], "page_id long, url string")
    rules = [url_filter.Rule("com", "/en/", "block"), url_filter.Rule("example.com", "/en/7", "allow"), url_filter.Rule("net", "/de/", "block"), url_filter.Rule("b", "", "block")]
    got = url_filter.judged(pages, rules, url_filter.hosts_with_words(pages, ["bad"])).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", r.url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fit = [x for x in rules if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fit, key=lambda x: (len(x.name), len(x.host)), default=None)
        verdict = best.verdict if best else "block" if "bad" in re.split(r"[.\-]", host) else "allow"
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best and best.name, verdict)


def test_url_rules_of_the_contract(spark, tmp_path):
    """The query's rules word by word, and their verdicts where host words would say the opposite."""
    assert [(r.host + r.path, r.verdict) for r in queries.RULES] == [("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block")]
    urls = ["http://a.net/de/1", "http://casino.net/de/1", "http://a.example.net/de/7", "http://a.example.net/de/81", "http://example.com/en/6", "http://spam.example.com/en/7", "http://b.org/es/", "http://b.org/en/"]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = [(r.rule, r.verdict) for r in queries.op3_url_filter(spark, str(tmp_path)).orderBy("page_id").collect()]
    assert got == [
        ("net/de/", "allow"), ("net/de/", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"),
        ("com/en/", "block"), ("example.com/en/7", "allow"), ("org/es/", "block"), (None, "allow"),
    ]


def test_cascade_is_exact(spark):
    universe = spark.range(30000).select(F.xxhash64("id").alias("key"))
    listed = spark.range(3000).select(F.xxhash64(F.col("id") * 7).alias("key"))
    cascade = url_filter.build(listed, universe)
    keys = np.array([r.key for r in universe.collect()]).view(np.uint64)
    want = {r.key for r in listed.collect()}
    assert (cascade.holds(keys) == np.array([int(k) in want for k in keys.view(np.int64)])).all() and len(cascade.levels) > 1
    assert not url_filter.build(listed.limit(0), universe).holds(keys[:10]).any()
    joined = url_filter.listed_column(universe, F.col("key"), listed, None, "x").agg(F.sum(F.col("x").cast("int"))).first()[0]
    assert joined == sum(int(k) in want for k in keys.view(np.int64))


def test_licences(spark, empty):
    rows = [
        (1, "Intro words here.\nReleased under the MIT License.\nMore words follow.", "a/b/one.py"),
        (2, "Licensed under the Apache License, Version 2.0.", "a/LICENSE"),
        (3, "nothing to see", "a/b/c/two.py"), (4, None, "z/three.py"), (5, "", None),
        (6, "This work is licensed under the GNU General Public License, version 3.", "a/b/c/d/COPYING"),
        (7, "plain", "a/b/c/d/e/f.py"), (8, "a license is a thing that people read", "q/x"),
    ]
    files = spark.createDataFrame(rows, "doc_id long, text string, path string")
    got = {r.doc_id: (r.licence, r.origin, r.licence_dir) for r in license_scan.licences(files, F.col("path")).collect()}
    assert got == {
        1: ("MIT", "header", None), 2: ("Apache-2.0", "licence file", None), 3: ("Apache-2.0", "inherited", "a"), 4: (None, None, None), 5: (None, None, None),
        6: ("GPL-3.0", "licence file", None), 7: ("GPL-3.0", "inherited", "a/b/c/d"), 8: (None, None, None),
    }
    assert license_scan.licences(empty, F.col("source")).count() == 0


def licences_by_brute_force(rows, threshold=0.8):
    """Every segment of every file against every template, and ancestors one by one."""
    templates = [(n, collections.Counter(license_scan.terms(x))) for n, x in license_scan.TEMPLATES]
    known = {t for _, x in templates for t in x}
    seen = collections.Counter(t for _, text, _ in rows for t in known & set(license_scan.terms(text or "")))
    idf = lambda t: 1 + math.log((1 + len(rows)) / (1 + (seen[t] if t in known else 0)))
    unit = lambda bag: {t: n * idf(t) / math.sqrt(sum((m * idf(u)) ** 2 for u, m in bag.items())) for t, n in bag.items()}
    units = [(n, unit(x)) for n, x in templates]
    of = {t: {n for n, x in templates if t in x} for t in known}
    own = {}
    for i, text, path in rows:
        bags = [collections.Counter(license_scan.terms(license_scan._COMMENT.sub("", x))) for x in (text or "").split("\n")]
        spans = set(license_scan.segments(bags))
        found = []
        for a, b in spans:
            mine = unit(sum(bags[a:b], collections.Counter())) if any(bags[a:b]) else {}
            for n, v in units:
                score = sum(w * mine.get(t, 0.0) for t, w in v.items())
                if score >= threshold and any(len(of[t]) <= license_scan.FEW for t in v if t in mine):
                    found.append((n == "Proprietary", -round(score, 9), n, a, b))
        lines = {j for f in found for j in range(f[3], f[4])}
        share = sum(len((text or "").split("\n")[j].split()) for j in lines) / max(1, len((text or "").split()))
        steps = [x for x in (path or "").split("/") if x]
        named = bool(steps) and re.match(license_scan.LICENCE_NAME.replace("(^|/)", ""), steps[-1]) is not None
        own[i] = (*(min(found)[2:3] or [None]), -min(found)[1], tuple(steps[:-1]), named or share >= 0.5) if found else (None, 0.0, tuple(steps[:-1]), False)
    given = {}
    for name, score, folder, is_file in own.values():
        if is_file:
            given[folder] = min(given.get(folder, (0, "~")), (-score, name))
    want = {}
    for i, (name, _, folder, is_file) in own.items():
        if name:
            want[i] = name, "licence file" if is_file else "header", None
        else:
            near = next((folder[:n] for n in range(len(folder), -1, -1) if folder[:n] in given), None)
            want[i] = (given[near][1], "inherited", "/".join(near)) if near is not None else (None, None, None)
    return want


def test_licences_by_brute_force(spark):
    rng = random.Random(8)
    mit = "MIT License\n\nCopyright (c) 2020 Jane Roe\n\n" + license_scan.BODIES[0][1].replace(". ", ".\n\n")
    texts = [
        mit, "BSD 3-Clause License\n\nCopyright (c) 2001, Someone\nAll rights reserved.\n\n" + license_scan.BODIES[2][1], license_scan.BODIES[3][1],
        "/*\n * " + license_scan.BODIES[6][1].replace("\n", "\n * ") + "\n */\nint main() { return 0; }\n" + prose(rng, 400),
        "# This project is licensed under the MIT License.\n" + prose(rng, 50), "// SPDX-License-Identifier: Apache-2.0\ncode();", "The MIT License (MIT)",
        "Licensed under the MIT License", "Distributed under the terms of the BSD 3-Clause License", "Copyright 2003 Someone. All rights reserved.", "All rights reserved.",
        "Released under the MIT License. See the file LICENSE for details.", "the license", "a license to read, version 2", None, "", prose(rng, 5000) + "\n" + mit,
    ]
    folders = ["", "a", "a/b", "a/b/c", "d", "d/e", "f//g", "h/i/j/k"]
    rows, names = [], ["LICENSE", "COPYING.txt", "one.py", "two.c", "notice-2.md", "readme"]
    for i in range(90):
        text = texts[i % len(texts)] if rng.random() < 0.4 else prose(rng, 30)
        rows.append((i, text, None if i == 50 else f"{rng.choice(folders)}/{rng.choice(names)}"))
    files = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, path string")
    got = [(r.doc_id, (r.licence, r.origin, r.licence_dir)) for r in license_scan.licences(files, F.col("path")).collect()]
    assert len(got) == len(rows) + 3 and dict(got) == licences_by_brute_force(rows + rows[:3])
    found = {t[:24]: n for (_, t, _), (_, (n, o, _)) in zip(rows, sorted(got)[: len(rows)], strict=False) if t and o in ("header", "licence file")}
    assert {"MIT", "BSD-3-Clause", "ISC", "Apache-2.0"} <= set(found.values())


def test_toxicity(spark, empty):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(500):
        words = prose(rng, rng.choice([20, 150])).split()
        toxic = i % 5 == 0
        for _ in range(4 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["gormless", "nitwit", "blockhead", "dimwit"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(0, 1), (77777, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks, F.col("doc_id") % 4 != 2)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i, _ in labels if i % 4 == 2]
    right = sum((got[i] >= 0.3) == (i % 5 == 0) for i in held)
    assert right >= 0.97 * len(held) and all(0 <= s <= 1 for s in got.values()) and got[900] == got[901]
    plain = toxicity.fit(docs, marks.limit(0), F.lit(True))
    assert toxicity.score(docs, plain).select("score").distinct().count() == 1
    assert toxicity.score(empty, model).count() == 0


CLASHES = ("__lines", "__rate", "host", "path", "rule", "verdict", "__list_host", "__kept", "__marks", "__key", "__score", "__mix_source", "copy", "__text", "__block", "__own", "score", "tie", "id", "key", "key_", "bands")


def test_clashing_columns(spark, docs):
    """Extra columns of any name pass through or aren't read; no operator crashes on them."""
    few = docs.filter("doc_id < 40 OR doc_id >= 1000")
    wide = few.select("*", *[F.lit(c).alias(c) for c in CLASHES])
    same = lambda df: all(r[c] == c for r in df.collect() for c in CLASHES)
    assert same(line_dedup.without_boilerplate(wide, n_lines="n_1", n_dropped="n_2"))
    assert same(mixing.mixed(wide)) and same(mixing.with_copies(wide, copies="n_3"))
    assert same(dart_minhash.deduplicated(wide))
    items = spark.createDataFrame([(None, few.filter("doc_id = 6").first().text), (1, "no such words here at all")], "item_id long, text string")
    cleaned = decontamination.clean(wide, items)
    assert same(cleaned) and cleaned.count() < few.count()
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(wide, items).collect()} >= {(6, None)}
    pages = wide.withColumn("url", F.lit("http://a.example.com/en/1")).drop("host_", "n_chars")
    judged = url_filter.judged(pages, [url_filter.Rule("com", "/en/", "block")])
    assert same(judged) and {(r.host_, r.path_, r.rule_, r.verdict_) for r in judged.collect()} == {("a.example.com", "/en/1", "com/en/", "block")}
    for f in (order_minhash.with_next, substring_dedup.without_repeats):
        assert sorted(map(tuple, f(wide).collect()), key=str) == sorted(map(tuple, f(few).collect()), key=str)
    scores = ngram_lm.scored(wide, F.col("doc_id") % 2 == 0)
    assert scores.count() == few.count()
    assert license_scan.licences(wide, F.lit("a/b")).count() == few.count()
    model = toxicity.train([("you idiot here", 1), ("a plain text", 0)] * 3)
    assert toxicity.score(wide, model, out="tox").filter("tox is not null").count() == few.count()


def test_exchanged_rows_grow_with_the_table():
    """Blocks times shards: the rows that op7 and op10 exchange, at most one for ROW_BYTES."""
    from helixmill.llm import shared

    for total in (2**p for p in range(20, 48)):
        blocks = max(16, -(-total // shared.grown(substring_dedup.BLOCK_BYTES, total)))
        bits, _ = substring_dedup.shards_for(total)
        assert blocks * 2**bits <= max(64, total // shared.ROW_BYTES)
        blocks = max(16, -(-total // shared.grown(ngram_lm.BLOCK_BYTES, total)))
        assert blocks * ngram_lm.shards_for(total) <= max(64, total // shared.ROW_BYTES)


def test_cascade_that_does_not_end_raises(spark, monkeypatch):
    keys = spark.range(400).select(url_filter.key_of(F.col("id")).alias("key"))
    monkeypatch.setattr(url_filter, "MOST_LEVELS", 1)
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", 1)
    with pytest.raises(ValueError, match="exact"):
        url_filter.build(keys.limit(200), keys)


def test_toxicity_of_odd_texts(spark):
    """Long, repeated, empty and missing texts; the share of the classes, not of the sample."""
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        words = prose(rng, 40).split()
        if i % 3 == 0:
            words[rng.randrange(40)] = rng.choice(["idiot", "moron", "scum"])
        rows.append((i, " ".join(words)))
        labels.append((i, 0, int(i % 3 == 0)))
    long_clean, long_toxic = prose(rng, 60_000), prose(rng, 30_000) + " you moron " + prose(rng, 30_000)
    rows += [(700, long_clean), (701, long_toxic), (702, long_toxic), (703, None), (704, ""), (None, long_toxic), (701, long_toxic)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, known, F.lit(True))
    assert model.trained
    score = collections.defaultdict(set)
    for r in toxicity.score(docs, model).collect():
        score[r.doc_id].add(r.score)
    assert all(len(x) == 1 and 0 <= min(x) <= 1 for x in score.values())
    assert min(score[701]) >= 0.3 and min(score[701]) > max(score[700]) and score[701] == score[702] == score[None]
    assert max(score[703] | score[704]) < 0.3
    # The table's shares, not the sample's, set the curve's place.
    sample = [(t, y) for (_, t), (_, _, y) in zip(rows, labels, strict=False)]
    rare, even = (toxicity.train(sample, toxic_share=x) for x in (0.1, 0.5))
    assert abs(rare.slope - even.slope) < 1e-6 and abs(even.intercept - rare.intercept - math.log(9)) < 0.05
    bounded = toxicity.fit(docs, known, F.lit(True), max_bytes=20_000)
    assert len(bounded.toxic) <= toxicity.TOXIC_BYTES and bounded.trained
    assert not toxicity.fit(docs, known.limit(0), F.lit(True)).trained
