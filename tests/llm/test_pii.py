"""Pseudonyms against a plain Python Feistel network; validation, linking, edge cases."""

import hashlib
import re
from datetime import date, timedelta

import pytest
import regex
from pyspark.sql import functions as F

from tableworks.llm import pii as P
from tests.conftest import SF_SMALL
from tests.llm.data import edge_docs, no_docs, small

KEY = "k1"


def keyed(tweak, step, value):
    return int(hashlib.sha256(f"{KEY}|{tweak}|{step}|{value}".encode()).hexdigest()[:15], 16)


def feistel(left, right, bl, br, tweak):
    for i in range(P.ROUNDS):
        if i % 2 == 0:
            left = (left + keyed(tweak, i, right)) % bl
        else:
            right = (right + keyed(tweak, i, left)) % br
    return left, right


def permute(digits, tweak):
    u = len(digits) // 2
    a, b = feistel(int(digits[:u]), int(digits[u:]), 10**u, 10 ** (len(digits) - u), tweak)
    return f"{a:0{u}d}{b:0{len(digits) - u}d}"


def refill(shape, digits):
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))


def brute(m):
    """The pseudonym of a match, or the match itself if it isn't valid."""
    if "@" in m:
        return f"user{hashlib.sha256(f'{KEY}|email|{m.lower()}'.encode()).hexdigest()[:16]}@mail.invalid"
    if m[0] == "+":
        head = re.match(r"\+\d{1,3}(?=[ .(-])|\+\d", m)[0]
        rest = m[len(head) :]
        return head + refill(rest, permute(re.sub(r"\D", "", rest), "phone"))
    for pattern, order, fmt in ((r"(\d{4})-(\d\d)-(\d\d)", (1, 2, 3), "%Y-%m-%d"), (r"(\d\d)/(\d\d)/(\d{4})", (3, 2, 1), "%d/%m/%Y"), (r"(\d\d)\.(\d\d)\.(\d{4})", (3, 2, 1), "%d.%m.%Y")):
        if hit := re.fullmatch(pattern, m):
            try:
                n = (date(*(int(hit[i]) for i in order)) - date(1900, 1, 1)).days
            except ValueError:
                return m
            if not 0 <= n < 270 * 270:
                return m
            a, b = feistel(n // 270, n % 270, 270, 270, "date")
            return (date(1900, 1, 1) + timedelta(a * 270 + b)).strftime(fmt)
    if "." in m:
        o = [int(x) for x in m.split(".")]
        if max(o) > 255:
            return m
        a, b = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "ipv4")
        return ".".join(map(str, (a >> 8, a & 255, b >> 8, b & 255)))
    digits = re.sub(r"\D", "", m)
    if re.fullmatch(r"\d{3}-\d\d-\d{4}", m):
        return refill(m, permute(digits, "ssn"))
    if luhn(digits) % 10:
        return m
    body = permute(digits[:-1], "card")
    return refill(m, body + str(-luhn(body + "0") % 10))


CASES = [
    "4929348385146306", "4929-3483-8514-6306", "4929 3483 8514 6306", "378282246310005", "3782 822463 10005", "9807915762804490",
    "+1 (487) 555-7209", "+44 20 123 4567", "123-45-6789", "233.254.104.120", "999.1.1.1", "0.0.0.0", "2024-02-29", "2023-02-29",
    "31/12/1999", "31.11.1999", "1899-12-31", "2099-12-31", "und.34@mail7.example.com", "é.7@x.example.org", "1.2.3", "v1.2.3.4.5",
    "12345678901234567890123", "4.0.",
]


PATTERN = regex.compile(P.FINDINGS.replace(r"\w", "A-Za-z0-9_").replace(r"\d", "[0-9]"))


def replaced(text):
    return PATTERN.sub(lambda m: brute(m[0]), text)


def test_formats_match_brute_force(spark):
    docs = spark.createDataFrame([(i, f"See {c} and {c}!! end") for i, c in enumerate(CASES)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in P.pseudonymize(docs, key=KEY).collect()}
    assert got == {i: replaced(f"See {c} and {c}!! end") for i, c in enumerate(CASES)}
    same = {c for i, c in enumerate(CASES) if got[i] == f"See {c} and {c}!! end"}
    assert same == {"9807915762804490", "999.1.1.1", "2023-02-29", "31.11.1999", "1899-12-31", "2099-12-31", "1.2.3", "v1.2.3.4.5", "12345678901234567890123", "4.0."}


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r["doc_id"]: r["text"] for r in P.pseudonymize(docs, key=KEY).collect()}
    assert got == {d["doc_id"]: replaced(d["text"]) for d in small("documents")}
    assert sum(got[d["doc_id"]] != d["text"] for d in small("documents")) > 3


def test_round_trip_restores_numbers_and_dates(spark):
    rows = [(i, f"x {c} y") for i, c in enumerate(CASES) if "@" not in c]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    back = P.pseudonymize(P.pseudonymize(docs, key=KEY), key=KEY, inverse=True)
    assert sorted(map(tuple, back.collect())) == rows


def test_permutation_is_one_to_one(spark):
    docs = spark.createDataFrame([(i, f"{i:03d}-00-0000") for i in range(1000)], "doc_id long, text string")
    got = [r["text"] for r in P.pseudonymize(docs, key=KEY).collect()]
    assert len(set(got)) == 1000
    other = [r["text"] for r in P.pseudonymize(docs, key="k2").collect()]
    assert sum(a == b for a, b in zip(sorted(got), sorted(other))) < 50


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = P.pseudonymize(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_edges(spark):
    docs = edge_docs(spark)
    got = P.pseudonymize(docs)
    assert got.schema == docs.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, docs.collect()))
    assert P.pseudonymize(no_docs(spark)).count() == 0
    counts = P.pseudonymize(docs, with_counts=True)
    assert counts.filter("n_email + n_card + n_phone + n_ipv4 + n_ssn + n_date <> 0").count() == 0
    with pytest.raises(ValueError):
        P.pseudonymize(counts, with_counts=True)


FORMS = {
    "phone": [
        "(017) 555-7713", "(017)555-7713", "017-555-7713", "017.555.7713", "487 555 7209", "1-487-555-7209", "01 23 45 67 89", "020 7946 0958",
        "0171/1234567", "(030) 123456", "+33 1 23 45 67 89", "+33123456789", "+44 (0)20 7946 0958", "+49 30 1234567", "+34 612 345 678",
        "+1 (487) 555-7209",
    ],
    "date": ["1984-03-25T10:00:00Z", "1984-03-25t10:00", "1984-03-25 10:00", "03/25/1984", "12/31/1999", "02/29/2024", "25/03/1984", "03/04/1984"],
}
STAY = ["555-7713", "02/30/2024", "13/13/2020", "02/29/2023", "1984-03-25x", "2024 1200 300 100", "1.2.3", "0123 4567 8901 2345", "12/31/1899"]


def test_common_forms_are_found(spark):
    rows = [(f"{k}{i}", f"on {c} or ({c}), end") for k, cs in FORMS.items() for i, c in enumerate(cs)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = P.pseudonymize(docs, key=KEY, with_counts=True)
    for r in got.collect():
        kind, was = r["doc_id"].rstrip("0123456789"), dict(rows)[r["doc_id"]]
        assert r["text"] != was and r[f"n_{kind}"] == 2, was
        assert re.sub(r"\d", "9", r["text"]) == re.sub(r"\d", "9", was)
        one, two = r["text"][3:-5].split(" or (")
        assert one == two[:-1], r["text"]
    back = P.pseudonymize(got.select("doc_id", "text"), key=KEY, inverse=True)
    assert {tuple(r) for r in back.collect()} == set(rows)
    stay = spark.createDataFrame([(i, f"see {c} end") for i, c in enumerate(STAY)], "doc_id long, text string")
    assert sorted(map(tuple, P.pseudonymize(stay, key=KEY).collect())) == sorted(map(tuple, stay.collect()))


def test_month_first_dates_match_brute_force(spark):
    late = [d for d in (date(1900, 1, 1) + timedelta(i) for i in range(73049)) if d.day > 12]
    base, want = P.LATE_BASE, {}
    for n, d in enumerate(late):
        if n < base * base:
            a, b = feistel(n // base, n % base, base, base, "date")
            want[d.strftime("%m/%d/%Y")] = late[a * base + b].strftime("%m/%d/%Y")
        else:
            want[d.strftime("%m/%d/%Y")] = d.strftime("%m/%d/%Y")
    docs = spark.createDataFrame([(k,) for k in want], "text string").withColumn("was", F.col("text"))
    assert {r["was"]: r["text"] for r in P.pseudonymize(docs, key=KEY).collect()} == want
    assert len(set(want.values())) == len(want) and late[base * base].year == 2099


def test_long_runs_need_no_stack(spark):
    """A recursive pattern would end the executor; every text here must come back."""
    texts = [
        "x@" + "a." * 3000 + "com", "x@" + "a." * 100 + "com", "x@a.b.com.1 y@b..com z@c-d.com...", "1 " * 100_000, "7" * 200_000,
        " " * 200_000, "a" * 200_000 + "@" + "b" * 200_000 + ".org", "+" * 50_000, "1-" * 50_000, "(0" * 50_000, "12/" * 50_000, "@" * 100_000, "x@" * 50_000,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in P.pseudonymize(df, with_counts=True).collect()}
    assert len(got) == len(texts)
    assert [got[i]["n_email"] for i in range(3)] == [0, 1, 2]  # a host name has at most 127 labels
    assert got[0]["text"] == texts[0] and got[2]["text"].endswith("...") and "y@b..com" in got[2]["text"]
    assert got[6]["n_email"] == 1 and all(got[i]["text"] == texts[i] for i in (3, 4, 5, 7, 11))
