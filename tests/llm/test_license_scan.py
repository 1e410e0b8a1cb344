"""License scans against a search word by word, and expressions against a recursive reading."""

import random
import re

import pytest
from ledgerfold.llm import license_scan, queries
from ledgerfold.llm.license_scan import evaluate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def places(text, phrases):
    words = WORD.findall(lowered(text))
    return sorted((i, p) for p in phrases for i in range(len(words)) if words[i : i + len(p.split())] == p.split()), len(words)


def expected(doc_id, text):
    base, n = places(text, license_scan.BASE)
    notes, _ = places(text, license_scan.NOTICES)
    own = {license_scan.BASE[p] for _, p in base}
    at = [i for i, _ in base]
    return doc_id, n, len(base), min(at, default=None), max(at, default=None), ",".join(sorted(own)), own | {license_scan.NOTICES[p] for _, p in notes}


PIECES = ["MIT", "License", "license", "the", "Apache", "General", "Public", "GENERAL PUBLIC LICENSE", "Lesser", "é", "CC", "BY", "NC", "-", "\n", ".", "_", "2.0", "ÄMIT", "public\x00license", "Creative", "Commons", ""]


def test_base_and_notices_equal_a_search_by_words(spark, tmp_path):
    rng = random.Random(2)
    texts = [None, "", "...", "MIT", "license", "mit -- \n LICENSE", "MIT license" * 3, "mit license " * 5000, *(" ".join(rng.choices(PIECES, k=rng.randint(0, 40))) for _ in range(500))]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(4, "license", "x", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, labels string, findings int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = {r[0]: expected(r[0], r[1]) for r in rows}
    got = queries.op11_license_scan(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    for r in got:
        assert (r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == want[r["doc_id"]][:6]
        assert set(r["labels"].split(",")) - {""} == want[r["doc_id"]][6] and 0 <= r["score"] <= 1
        assert (r["score"] > 0) == bool(want[r["doc_id"]][6])


def test_query_on_documents(spark):
    d = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = queries.op11_license_scan(spark, d).collect()
    assert len(got) == len(docs) and any(r["n_base"] for r in got)
    for r in got:
        assert (r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == expected(r["doc_id"], docs[r["doc_id"]])[:6]


def recursive(tokens):
    """Freedom of a whole expression, by splitting at the operator that binds least and stands last."""
    while tokens[0] == "(" and match(tokens) == len(tokens) - 1:
        tokens = tokens[1:-1]
    for kind in ("OR", "AND", "WITH"):
        depth = 0
        for i in range(len(tokens) - 1, -1, -1):
            depth += (tokens[i] == ")") - (tokens[i] == "(")
            if depth == 0 and tokens[i] == kind:
                a = recursive(tokens[:i])
                if kind == "WITH":
                    return license_scan.WEAK if a == license_scan.STRONG else a
                b = recursive(tokens[i + 1 :])
                return max(a, b) if kind == "OR" else min(a, b)
    return license_scan.FREE.get(license_scan.family(tokens[0]), license_scan.UNKNOWN)


def match(tokens):
    depth = 0
    for i, t in enumerate(tokens):
        depth += (t == "(") - (t == ")")
        if not depth:
            return i
    return -1


def made(rng, depth):
    names = ["MIT", "Apache-2.0", "GPL-2.0-only", "LGPL-3.0+", "CC-BY-NC-4.0", "Foo-1", "BSD-3-Clause"]
    kind = rng.random()
    if depth == 0 or kind < 0.3:
        return [rng.choice(names)] + (["WITH", "Classpath-exception-2.0"] if rng.random() < 0.2 else [])
    if kind < 0.5:
        return ["(", *made(rng, depth - 1), ")"]
    return [*made(rng, depth - 1), rng.choice(["AND", "OR"]), *made(rng, depth - 1)]


def test_expressions_equal_a_recursive_reading():
    rng = random.Random(5)
    for _ in range(1500):
        tokens = made(rng, 4)
        text = re.sub(r"\( | \)", lambda m: m[0].strip(), " ".join(tokens))
        read = evaluate(text.encode())
        assert read is not None and read[0] == text and read[2] == recursive(tokens), text


@pytest.mark.parametrize(
    "text, names, freedom",
    [
        ("MIT", ["mit"], 1.0),
        ("MIT. See the file", ["mit"], 1.0),
        ("MIT and others", ["mit", "other"], 0.2),
        ("GPL-2.0-only WITH Classpath-exception-2.0 */", ["gpl"], 0.6),
        ("(MIT OR GPL-3.0", ["mit", "gpl"], 0.3),
        ("mit or gpl-3.0) x", ["mit", "gpl"], 1.0),
        ("MIT OR", ["mit"], 1.0),
        ("( ( ( MIT ) ) )", ["mit"], 1.0),
        ("Mitra", ["other"], 0.2),
    ],
)
def test_expression_cases(text, names, freedom):
    assert evaluate(text.encode())[1:] == (names, freedom)


def test_nothing_to_read():
    assert evaluate(b"") is None and evaluate(b"AND MIT") is None and evaluate(b"()") is None and evaluate(b"*/") is None
    assert evaluate(b"(" * 50_000 + b"MIT" + b")" * 50_000)[2] == 1.0


def test_tags(spark):
    texts = [
        "// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND BSD-3-Clause\nint x;",
        'license = "Apache-2.0"',
        "license: see below",
        "The license of this text",
        "SPDX-License-Identifier: Foo-1.0",
        "SPDX-License-Identifier:\nMIT",
        "# SPDX license identifier : GPL-3.0-or-later WITH GCC-exception-3.1. Lesser General Public License",
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["score"], r["expressions"]) for r in license_scan.digest(license_scan.license_scan(docs)).collect()}
    assert got == {
        0: ("bsd,gpl,mit", 1.0, "(MIT OR GPL-2.0-only) AND BSD-3-Clause"),
        1: ("apache", 1.0, "Apache-2.0"),
        2: ("", 0.0, ""),
        3: ("", 0.0, ""),
        4: ("other", 0.2, "Foo-1.0"),
        5: ("", 0.0, ""),
        6: ("gpl,lgpl", 0.3, "GPL-3.0-or-later WITH GCC-exception-3.1"),
    }


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "MIT License"), (None, None)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["n_words"], len(r["findings"])) for r in license_scan.license_scan(docs).collect()) == [(None, 0, 0), (None, 2, 1)]
    assert license_scan.digest(license_scan.license_scan(docs.limit(0))).count() == 0
