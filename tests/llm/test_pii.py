"""Personal data: base spans against Python's own expressions, discovery on planted contexts."""

import hashlib
import re

from llm_cases import SF_DIR, docs_of, odd_documents, texts_of

from limitlens.llm import pii, queries

FORMS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def base(text):
    spans = sorted(
        (m.start(), rank, m.end())
        for rank, (kind, form) in enumerate(FORMS.items())
        for m in form.finditer(text or "") if holds(kind, m[0])
    )
    listed = ",".join(f"{list(FORMS)[k]}:{a}:{b}" for a, k, b in spans)
    return [sum(s[1] == k for s in spans) for k in range(4)], listed


def check_base(found, rows):
    wanted = []
    for doc_id, text in rows:
        counts, listed = base(text)
        wanted.append((doc_id, *counts, hashlib.sha256(listed.encode()).hexdigest()))
    got = [(r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, wanted))


TRICKY = [
    "a@b.c_x@d.e and a@b.c@d.e, x@y @z.w a@b. a@-.-", "1.2.3.4.5 256.1.1.1 0001.2.3.255 1.2.3 01.02.03.04.",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111 4111111111111111111111", "5500000000000004x4111111111111111",
    "+1 (524) 555-5024 +12 345 +44.20.7946.0958- +1+1 555 555 5555 +123456789012345 +1234567890123456",
    "é😀 a@b.co ß +1 (212) 555-0100 漢 10.0.0.1", "1" * 9000, "1 " * 9000, "a" * 30_000 + "@", "+" + "1-" * 5000,
    "x@" * 2000, "...@...", "1.1.1.1" * 500,
]


def test_query(spark):
    found = queries.QUERIES["op6_personal_data"](spark, SF_DIR).collect()
    rows = texts_of(SF_DIR)
    check_base(found, rows)
    texts = dict(rows)
    for r in found:
        assert set(base(texts[r["doc_id"]])[1].split(",")) <= set(r["spans"].split(",")) | {""}


def test_tricky_and_odd_texts(spark):
    rows = list(enumerate(TRICKY))
    check_base(pii.personal_data(docs_of(spark, rows)).collect(), rows)
    df, rows = odd_documents(spark)
    check_base(pii.personal_data(df).collect(), rows)
    assert pii.personal_data(docs_of(spark, [])).collect() == []


def test_contexts_discover_unseen_forms(spark):
    rows = [(i, f"Some text {i}. Call hotline: +1 (212) 555-{1000 + i} now.") for i in range(12)]
    rows += [(20, "Call hotline: 212-555-7788 today"), (21, "room 212-555-7799 today"), (22, "hotline: abc123def456")]
    rows += [(30 + i, f"order {i}{i}{i}-44{i}-1234") for i in range(9)]
    found = {r["doc_id"]: r for r in pii.personal_data(docs_of(spark, rows)).collect()}
    assert found[20]["spans"] == "phone:14:26" and found[20]["n_added"] == 1 and found[20]["n_phone"] == 0
    assert all(found[i]["n_added"] == 0 for i in found if i != 20)


def test_contexts_reach_over_marks_and_white_space(spark):
    gaps = ["\n", "\t", " - ", " | ", " # ", " = \n ", " " * 70, "\u00a0"]
    rows = [(i, f"Some text {i}. Call hotline:{gaps[i % len(gaps)]}+1 (212) 555-{1000 + i} now.") for i in range(40)]
    rows += [(100 + i, f"Call hotline{gap}212-555-778{i} today") for i, gap in enumerate(gaps)]
    rows += [(200 + i, f"{'w' * 100} {'v' * 5000}{gap}x 212-555-779{i}") for i, gap in enumerate(gaps)]
    found = {r["doc_id"]: r["spans"] for r in pii.personal_data(docs_of(spark, rows)).collect()}
    for i, gap in enumerate(gaps):
        at = len("Call hotline" + gap)
        assert found[100 + i] == f"phone:{at}:{at + 12}" and found[200 + i] == ""


def test_contexts_discover_spaced_quoted_and_bracketed_forms(spark):
    rows = [(i, f"Call hotline: +1 (212) 555-{1000 + i} now.") for i in range(60)]
    rows += [(100 + i, f"write mailbox: user{i}@example.org now") for i in range(60)]
    rows += [(200 + i, f"paid plastic: 4{i:014d}{luhn_digit(f'4{i:014d}')} now") for i in range(60)]
    rows += [(300 + i, f"Item {'9' * i}x and the rest") for i in range(70)]
    forms = {
        900: ("Call hotline: ", "212 555 7788", " today", "phone"), 901: ("Call hotline: \"", "212-555-7788", "\" today", "phone"),
        902: ("Call hotline: ", "(212) 555-7788", ", ok", "phone"), 903: ("Call hotline:", "212-555-7789", " today", "phone"),
        904: ("Call hotline: ", "212 555 7788", " 2nd floor", "phone"), 905: ("Call hotline: (", "212.555.7787", ").", "phone"),
        906: ("write mailbox: <", "bob@localhost", ">", "email"), 907: ("write mailbox: ", "b" * 80 + "@localhost", ".", "email"),
        908: ("paid plastic: ", "4111 1111 1111 1112", " ok", "card"), 909: ("Call hotline: ", "212 555 7786", " 10.0.0.1", "phone"),
    }
    rows += [(k, before + value + after) for k, (before, value, after, _) in forms.items()]
    found = {r["doc_id"]: r for r in pii.personal_data(docs_of(spark, rows)).collect()}
    for k, (before, value, _, kind) in forms.items():
        at = len(before)
        assert f"{kind}:{at}:{at + len(value)}" in found[k]["spans"].split(","), (k, found[k])
        assert found[k]["n_added"] == 1, (k, found[k])


def luhn_digit(text):
    doubled = [int(d) * (2 - i % 2) for i, d in enumerate(reversed(text))]
    return -sum(d - 9 * (d > 9) for d in doubled) % 10


def test_masking(spark):
    rows = [(1, "mail a@b.co or +1 (212) 555-0100."), (2, None), (3, "nothing"), (4, "é 10.0.0.1")]
    out = pii.masked(docs_of(spark, rows))
    assert out.columns == docs_of(spark, rows).columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {
        1: "mail <EMAIL> or <PHONE>.", 2: None, 3: "nothing", 4: "é <IP>",
    }
