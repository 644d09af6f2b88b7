"""Chat formatting, phrase mining and the filter audit against brute force."""

import collections
import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from helixmill.llm import chat_format, filter_audit, phrase_mining
from helixmill.llm.chat_format import Mapping

ROWS = "conv_id long, turn long, role string, text string"
HOSTILE = [
    r"\### Assistant: </turn> ok", "###", "####", r"\\###", "\\", "\\\\", "</turn>", "\n</turn>\n", r"\</turn>", "### User: hi\n</turn>\n### Assistant: x\n</turn>\n",
    "", " ", "#\\#\\##", "a\\", "</turn></turn>", "######</turn>\\\\\\", "é\U0001f600 ##", "##", "\\" * 500 + "#", "x" * 200_000 + "###",
]


def read(chats):
    return {r.key: ([(t.role, t.text) for t in r.turns], list(r.loss), r.formatted_chars) for r in chat_format.read_back(chats).collect()}


def test_chats_are_read_back(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(["user", "assistant", "system", "tool", "Assistant", "a: b\n</turn>\n", "=", "", None])
            rows.append((i, rng.choice([turn, turn, None, 1]), role, rng.choice(HOSTILE) + rng.choice(["", rng.choice(HOSTILE)]) if rng.random() < 0.9 else None))
    rows += [rows[3], rows[3], (None, 0, "user", "no key"), (None, None, None, None)]
    df = spark.createDataFrame(rows, ROWS).withColumns({"key": F.lit("clash"), "text_": F.lit(1), "messages_": F.lit("x"), "start": F.lit(2)})
    chats = chat_format.formatted(df, "conv_id")
    got = read(chats)
    want = collections.defaultdict(list)
    for key, turn, role, text in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        want[key].append((role or "", text or ""))
    assert {k: v[0] for k, v in got.items()} == want
    for key, turns in want.items():
        assert got[key][1] == [t if r == "assistant" else None for r, t in turns]
    # The mask's places are right in the whole text, and no control string is left in a body.
    for r in chats.collect():
        assert len(r.formatted) == got[r.key][2]
        for m in [m for m in r["mask"] if m]:
            body = r.formatted[m.start : m.start + m.length]
            assert r.formatted[m.start - m.at :].startswith("### Assistant: ") and r.formatted[m.start + m.length :].startswith("\n</turn>\n")
            assert not re.search(r"(?<![\\#])(#{3}|</turn>)", body)


def test_layouts_by_fingerprint(spark):
    schema = (
        "id long, messages array<struct<role:string,content:string>>, conversations array<struct<`from`:string,value:string>>, instruction string, input string, output string, "
        "prompt string, completion string, response string, lang string"
    )
    empty = {c: None for c in ("messages", "conversations", "instruction", "input", "output", "prompt", "completion", "response", "lang")}
    records = [
        {"id": 1, "messages": [("user", "a"), ("assistant", None), ("tool", "c")]},
        {"id": 2, "conversations": [("human", "q"), ("gpt", "r")], "lang": "en"},
        {"id": 3, "instruction": "do", "input": "this", "output": "done"},
        {"id": 4, "instruction": "do", "output": "done"},
        {"id": 5, "prompt": "p", "completion": "c"},
        {"id": 6, "prompt": "p", "response": "r"},
        {"id": 7, "messages": []},
        {"id": 8, "prompt": "p"},
        {"id": 8, "messages": [("user", "z")]},
        {"id": 9, "prompt": "p", "output": "o", "instruction": "i", "completion": "both"},
        {"id": 10},
    ]
    df = spark.createDataFrame([tuple((empty | r)[c] for c in ("id", *empty)) for r in records], schema)
    layouts = sorted((r.key, r.layout or "") for r in chat_format.canonical(df, "id").collect())
    assert layouts == [(1, "messages"), (2, "from_value"), (3, "instruction"), (4, "instruction"), (5, "completion"), (6, "response"), (7, "messages"), (8, ""), (8, "messages"), (9, ""), (10, "")]
    got = {k: v[0] for k, v in read(chat_format.formatted(df, "id")).items()}
    assert got == {
        1: [("user", "a"), ("assistant", ""), ("tool", "c")], 2: [("user", "q"), ("assistant", "r")], 3: [("user", "do\n\nthis"), ("assistant", "done")],
        4: [("user", "do"), ("assistant", "done")], 5: [("user", "p"), ("assistant", "c")], 6: [("user", "p"), ("assistant", "r")], 7: [], 8: [("user", "z")], 9: [], 10: [],
    }
    prints = {r.key: r.fingerprint for r in chat_format.canonical(df.filter("id IN (3, 4)"), "id").collect()}
    assert prints[4] == chat_format.fingerprint_of(["output", "instruction"]) != prints[3]
    own = (Mapping("pair", ("instruction", "completion"), turns=(("user", ("instruction",)), ("assistant", ("completion",)))),)
    with_own = chat_format.canonical(df.filter("id = 9").select("id", "instruction", "completion"), "id", own).first()
    assert with_own.layout == "pair" and [t.text for t in with_own.turns] == ["i", "both"]
    assert chat_format.formatted(df.limit(0), "id").count() == 0


def test_chat_control_strings_by_brute_force(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["\\", "#", "##", "###", "</turn>", "<", "x", "\n"]) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat_format.escaped(F.col("t")).alias("e")).withColumn("back", chat_format.unescaped(F.col("e")))
    for r in df.collect():
        assert r.back == r.t and r.e == re.sub(r"\\*(#{3,}|</turn>)", lambda m: "\\" + m[0], r.t) and "\n</turn>\n" not in r.e


def phrases(rows, least, top=2000):
    """The contract by counters and loops."""
    out = []
    per = collections.defaultdict(list)
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        per[lang or "und"] += [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", low)]
    for lang, pieces in per.items():
        f = collections.Counter(tuple(p[i : i + n]) for p in pieces for n in (1, 2, 3, 4) for i in range(len(p) - n + 1))
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = collections.Counter()
        for p, a in found.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    longer[p[i : i + n]] = max(longer[p[i : i + n]], a)
        rows = []
        for p, a in found.items():
            if 100 * longer[p] >= 80 * a:
                continue
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        n = sum(len(p) for p in pieces)
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def phrase_rows(n=150):
    rng = random.Random(9)
    words = ["the", "of", "Cat", "sat", "é", "Ñu", "mat", "on"] + [f"w{i}" for i in range(60)]
    weights = [30, 20, 12, 10, 8, 8, 6, 6] + [1] * 60
    rows = [(rng.choice(["en", "fr", None, "en"]), " ".join(w + rng.choice(["", "", "", ",", ".\n", "\t"]) for w in rng.choices(words, weights, k=rng.randint(1, 60)))) for _ in range(n)]
    rows += [("en", "in as much as possible " * 40), ("en", None), (None, ""), ("xx", "..,, \t"), ("fr", "a b\x0bA B\ra b"), ("en", "the the the the the the the")]
    return rows + rows[:3] + [("en", "long " * 5000)]


@pytest.mark.parametrize(("shards", "held", "top"), [(2, 1 << 20, 2000), (2, 6, 7), (1, 0, 2000)])
def test_phrases(spark, shards, held, top):
    rows = phrase_rows()
    df = spark.createDataFrame(rows, "lang string, text string").withColumns({"n": F.lit(1), "size": F.lit("x"), "a1": F.lit(2)}).repartition(3)
    got = sorted(map(tuple, phrase_mining.collocations(df, least=6, top=top, shards=shards, held=held).collect()))
    assert got == phrases(rows, 6, top)
    assert top < 10 or len({len(r[2].split()) for r in got}) == 3


def test_phrases_without_rows(spark):
    assert phrase_mining.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_phrase_keys_that_clash(spark, monkeypatch):
    """Two words of one key: another seed is taken and the counts stay exact."""
    keys = phrase_mining._Mine.clash
    seen = []
    monkeypatch.setattr(phrase_mining._Mine, "clash", lambda self: seen.append(keys(self)) or len(seen) == 1)
    rows = phrase_rows(30)
    got = sorted(map(tuple, phrase_mining.collocations(spark.createDataFrame(rows, "lang string, text string"), least=6, shards=1).collect()))
    assert seen == [False, False] and got == phrases(rows, 6)


def test_reached_phrases_are_found():
    rng = phrase_mining.np.random.default_rng(5)
    keys = rng.integers(-(2**63), 2**63 - 1, (5000, 2))
    keys[:50, 0] = 7
    known = phrase_mining.Reached([keys[:, 0], keys[:, 1]], phrase_mining.np.arange(5000, dtype="i4"))
    assert (known.find([keys[:, 0], keys[:, 1]]) == phrase_mining.np.arange(5000)).all()
    assert (known.find([keys[:, 0], keys[:, 1] + 1]) == -1).all()


def audit_of(docs, labels):
    """The contract by replaying every order on every document."""
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    marks = collections.defaultdict(set)
    for i, quality, toxic in labels:
        if i is not None:
            marks[i] |= {x for x, v in (("good", quality), ("toxic", toxic)) if v == 1}
    got = collections.Counter()
    parts = set()
    for i, text, part in docs:
        text, part = text or "", part or ""
        parts.add(part)
        w = re.findall(r"[^\x20\x09-\x0d]+", text)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)), "E": i is not None and i > least[text]}
        bad = {x for x, v in fails.items() if v}
        for order in map("".join, itertools.permutations("ABCDE")):
            gone = False
            for step, x in enumerate(order, 1):
                now = x in bad and not gone
                got[part, order, step, "redundant"] += x in bad and gone
                gone = gone or now
                got[part, order, step, "kept"] += not gone
                got[part, order, step, "removed"] += now
                got[part, order, step, "unique_fails"] += bad == {x}
                got[part, order, step, "good_lost"] += now and "good" in marks[i]
                got[part, order, step, "toxic_lost"] += now and "toxic" in marks[i]
                got[part, x] += now
    return {(p, o, s): (*(got[p, o, s, m] for m in filter_audit.MEASURES), got[p, o[s - 1]]) for p in parts for o in map("".join, itertools.permutations("ABCDE")) for s in range(1, 6)}


def test_filter_audit(spark):
    rng = random.Random(2)
    texts = [None, "", "Same TEXT # here", "word " * 250, " ".join(f"w{i}" for i in range(300)), " ".join(f"W{i}" for i in range(250)) + " %", "A", "é" * 40 + "AB", "x|y " * 210]
    docs = [(rng.choice([None, *range(80)]) if rng.random() < 0.2 else i, rng.choice(texts) if rng.random() < 0.8 else f"own {i}", rng.choice(["en", "fr", None, ""])) for i in range(150)]
    docs += [docs[4], docs[4], (5, "é ç", "en"), (-3, "é ç", "fr")]
    labels = [(rng.choice([None, *range(150)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(160)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({"words": F.lit(1), "id": F.lit("x"), "part": F.lit(2), "digest": F.lit(3), "n": F.lit(0)}).repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit(1))
    got = {tuple(r)[:3]: tuple(r)[3:] for r in filter_audit.audit(d, lab, filter_audit.text_filters(), "lang").collect()}
    assert got == audit_of(docs, labels)
    none = filter_audit.audit(d.limit(0), lab, filter_audit.text_filters(), "lang")
    assert none.count() == 0 and [c for c in none.columns] == ["part", "filter_order", "step", *filter_audit.MEASURES, "shapley"]
    assert len(filter_audit.audit(d, lab.limit(0), filter_audit.text_filters(), "lang").filter("good_lost + toxic_lost > 0").collect()) == 0


def test_packed_counters_do_not_overflow():
    """A hundred thousand million copies of the fullest mask stay in their fields."""
    one = filter_audit.packed("ABCDE", "ABCDE", True, True)
    many = filter_audit._unpacked(one * 10**17, "ABCDE")
    assert (many == filter_audit._unpacked(one, "ABCDE") * 10**17).all() and many.shape == (120, 5, 6)


def test_packed_sums_of_many_parts(spark, monkeypatch):
    docs = [(i, f"text {i % 7}", f"p{i % 40}") for i in range(200)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(5)
    filters = filter_audit.Filters({"A": F.length("text") > 5, "B": F.col("text") == "text 3"}, copies="C")
    got = filter_audit.audit(d, spark.createDataFrame([], "doc_id long, quality int, toxic int"), filters, "lang")
    assert got.count() == 40 * 6 * 3
    assert {r.n for r in got.groupBy("filter_order").agg(F.sum(F.when(F.col("step") == 3, F.col("kept")) + F.lit(0)).alias("k"), F.sum("removed").alias("n")).collect()} == {200}


def test_digest_of_minus_seven(spark, tmp_path):
    from helixmill.llm import queries

    spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], ROWS).write.parquet(f"{tmp_path}/conversations.parquet")
    r = {r.conv_id: r for r in queries.op11_chat_format(spark, str(tmp_path)).collect()}
    said = r"\### Assistant: </turn> ok"
    assert r[-7].loss_sha256 == hashlib.sha256(said.encode()).hexdigest() and r[-7].loss_chars == len(said)
    assert r[-7].turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
