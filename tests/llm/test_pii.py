import hashlib
import random
import re

from nightledger.llm import pii
from nightledger.llm.queries import QUERIES

from .conftest import ODD, prose


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def by_hand(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return sorted(out)


def base(row):
    return [(s["start"], s["order"], s["end"], s["kind"]) for s in row["found"] if s["base"]]


def check(docs, rows):
    texts = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    key = lambda x: repr(x)
    assert sorted(((r["doc_id"], base(r)) for r in rows), key=key) == sorted(((i, by_hand(t)) for i, t in texts), key=key)


def test_base_spans_match_brute_force(small_docs):
    check(small_docs, pii.detect(small_docs).collect())


def test_random_fragments_match_brute_force(make_docs):
    rng = random.Random(4)
    parts = ["a.b@c.de", "@", ".", "x_y%z@q-r.s.t", "1.2.3.4", "256.1.1.1", "001.2.03.255", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "+1 (555) 123-4567", "+", "12", " ", "-", "é😀", "\n", "79927398713", "+49 30 1234567 89", "a@b", "7", "abc", ")"]
    docs = make_docs([(i, "".join(rng.choices(parts, k=rng.randrange(25)))) for i in range(1500)])
    check(docs, pii.detect(docs).collect())


def test_many_spans_in_one_document(make_docs):
    docs = make_docs([(1, " ".join(f"u{i}@h{i}.org 10.0.{i % 300}.1" for i in range(700))), (2, "9" * 50_000 + "." * 1000 + "a" * 100_000 + "@x")])
    check(docs, pii.detect(docs).collect())


def test_model_adds_secrets_and_leaves_prose_alone(make_docs):
    rng = random.Random(2)
    hexes = ["%040x" % rng.getrandbits(160) for _ in range(160)]
    docs = [(i, f"{prose(i, 20)} token = \"{h}\" {prose(i + 1, 5)}") for i, h in enumerate(hexes)]
    docs += [(1000 + i, f"{prose(i, 20)} {'verylongword' * 3}{'abcdefgh'[i % 8]} {prose(i, 5)} commit {h[:24]} done") for i, h in enumerate(hexes)]
    rows = {r["doc_id"]: r["found"] for r in pii.detect(make_docs(docs)).collect()}
    found = sum(any(s["kind"] == "secret" and t[s["start"]:s["end"]] == hexes[i] for s in rows[i]) for i, t in docs[:160])
    assert found >= 144
    assert sum(len(rows[i]) for i, _ in docs[160:]) <= 8
    plain = [(i, prose(i, 60)) for i in range(50)]
    assert all(not r["found"] for r in pii.detect(make_docs(plain)).collect())


def test_model_adds_secrets_of_a_small_table(make_docs):
    rng = random.Random(6)
    hexes = ["%040x" % rng.getrandbits(160) for _ in range(13)]
    docs = [(i, f"{prose(i, 20)} token = \"{h}\" {prose(i + 1, 5)}") for i, h in enumerate(hexes)]
    docs += [(100 + i, f"{prose(i, 9)} {'verylongword' * 2} {prose(i, 5)} 12 {i % 7} 2024-01-{10 + i} u{i}@h.org") for i in range(20)]
    rows = {r["doc_id"]: r["found"] for r in pii.detect(make_docs(docs)).collect()}
    assert all([t[s["start"]:s["end"]] for s in rows[i] if s["kind"] == "secret"] == [hexes[i]] for i, t in docs[:13])
    assert not any(s["kind"] == "secret" for i, _ in docs[13:] for s in rows[i])


def test_sample_keeps_rare_kinds_whole():
    assert pii._shares([13, 2, 5], 20_000) == [1.0, 1.0, 1.0]
    counts = [10 ** 12, 30, 10 ** 9]
    shares = pii._shares(counts, 20_000)
    assert shares[1] == 1.0 and 0 < shares[0] < shares[2] < 1
    assert abs(sum(n * s for n, s in zip(counts, shares)) - 20_000) < 1
    assert pii._shares([], 20_000) == []


def test_thresholds_count_candidates_outside_the_sample(make_docs):
    rng = random.Random(8)
    docs = [(i, f"{prose(i, 9)} token = \"{rng.getrandbits(160):040x}\" x") for i in range(12)]
    docs += [(100 + i, f"{prose(i, 9)} {' '.join(str(rng.randrange(10, 99)) for _ in range(40))}. {'verylongword' * 2} 7") for i in range(200)]
    docs = make_docs(docs)
    model = pii.train(docs, pii.Training(train_rows=60))
    assert "secret" in model.thresholds
    assert sum(s["kind"] == "secret" for r in pii.find(docs, "found", model).collect() for s in r["found"]) == 12


def test_redaction(make_docs):
    docs = make_docs([(1, "mail é.a@b.co or +1 555 123 4567, 😀 10.0.0.1!"), (2, "nothing"), (3, None), (4, ""),
                      (5, "+1 555 123 4567 8901 2"), (5, "+1 555 123 4567 8901 2")])
    out = pii.redact(docs)
    assert out.columns == docs.columns
    rows = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    assert rows[:4] == [(1, "mail é[EMAIL] or [PHONE], 😀 [IP]!"), (2, "nothing"), (3, None), (4, "")]
    assert len(rows) == 6


def test_no_python_on_the_main_path(small_docs):
    model = pii.Model([(1.0, "tree\n  If (feature 0 <= 5.0)\n   Predict: 0.5\n  Else (feature 0 > 5.0)\n   Predict: -0.5\n")], {"secret": 0.5})
    plan = pii.find(small_docs, "found", model)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_query_columns(spark, sf_small, small_docs):
    rows = {r["doc_id"]: r for r in QUERIES["op1_boosted_pii"](spark, sf_small).collect()}
    for r in small_docs.collect():
        spans, got = by_hand(r["text"]), rows[r["doc_id"]]
        listed = [f"{k}:{s}:{e}" for s, _, e, k in spans]
        assert got["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [got[f"n_{k}"] for k in pii.BASE] == [sum(s[3] == k for s in spans) for k in pii.BASE]
        assert set(listed) <= set(got["spans"].split(",")) | {""}


def test_odd_rows_and_empty_table(odd_docs, no_docs):
    check(odd_docs, pii.detect(odd_docs).collect())
    assert pii.redact(odd_docs).count() == len(ODD)
    assert pii.detect(no_docs).count() == 0 and pii.redact(no_docs).count() == 0
