import pathlib
import random
import re

import pytest
from pyspark.sql import functions as F

from sarweave.llm import licenses, pii, quality_rules, queries
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def op4(text):
    """The base counts, one text at a time."""
    t = text or ""
    ws = brute.WORD.findall(t)
    lines = [x for x in t.split("\n") if brute.WORD.search(x)]
    grams = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)} if len(grams) < 400 else None
    if covered is None:
        n = {}
        for g in grams:
            n[g] = n.get(g, 0) + 1
        covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    base = len(ws) < 50 or 100 * len(covered) > 50 * len(ws)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), base


def odd_texts():
    r = random.Random(3)
    yield from (None, "", " \n\t ", "a", "a b c a b c", "a b\na b\n\na b", "ü" * 9 + " \x0b ßß\x0c#|<", "x y z " * 30000, "\r\n".join(["l1", "l2", "l1 "] * 30), "\x1c\x85\xa0 a b")
    for _ in range(40):
        yield "".join(r.choice(["a ", "b ", "c\n", "d\t", "e$ ", "f", "'\\ "]) for _ in range(r.randint(1, 200)))


def test_quality_rules(spark):
    rows = [(i if i % 7 else None, t, "own") for i, t in enumerate(odd_texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    got = quality_rules.quality_rules(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = sorted(((d, *op4(t)) for d, t, _ in rows), key=repr)
    assert sorted(((r.doc_id, *(r[n] for n in names)) for r in got), key=repr) == want
    assert all(not r.kept for r in got if r.base_failed)
    assert quality_rules.quality_rules(docs.limit(0)).count() == 0


def test_quality_rules_run_no_python(spark, capsys):
    quality_rules.quality_rules(spark.read.parquet(f"{SF}/documents.parquet")).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and not re.search("Python|Arrow|Pandas", plan)


def test_clean_documents_are_kept(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = quality_rules.quality_rules(docs).where("NOT base_failed").join(labels, "doc_id").toPandas()
    assert out[out.quality == 1].kept.mean() > 0.98 and out[out.quality == 0].kept.mean() < 0.2


def test_licenses(spark):
    mit = licenses.KNOWN["MIT"][2]
    rows = [
        (1, "Copyright (c) 2019 Some One\n\n" + mit.upper()), (2, mit.replace("sublicense", "sub-license").replace(",", " ,")), (3, mit + " extra"),
        (4, "Text.\nLicenced under CC BY-NC 4.0"), (5, None), (6, ""), (None, "Licensed under the MIT Licence"), (7, "word " * 30000), (1, "Licensed under the MIT Licence"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("license", "digest", "line_licenses")})
    got = sorted((r.doc_id or 0, r.license, r.line_licenses, r.permissive) for r in licenses.scan_licenses(docs).collect())
    assert [g for g in got if g[0] in (2, 3, 4, 5, 6, 7)] == [(2, "MIT", "", True), (3, None, "", None), (4, None, "CC-BY-NC-4.0", False), (5, None, "", None), (6, None, "", None), (7, None, "", None)]
    assert {g[1] for g in got if g[0] in (0, 1)} == {"MIT"} and licenses.scan_licenses(docs.limit(0)).count() == 0


def test_whole_licenses_as_published(spark):
    own = {p.name.split(".txt")[0]: p.read_text() for p in (pathlib.Path(licenses.__file__).parent / "license_texts").glob("*.txt")}
    want = [(t, name.removesuffix(".spdx").removesuffix(".regents")) for name, t in own.items()]
    mine, bsd = licenses.KNOWN["MIT"][2], own["BSD-3-Clause"]
    bsd = bsd[bsd.index("Redistribution") :]
    want += [(f"{title}\n\nCopyright (c) 2019 Some One\n{rights}\n{mine}\n", "MIT") for title in ("MIT License", "The MIT License (MIT)") for rights in ("", "All rights reserved.\n")]
    want += [(f"ISC License\n\nCopyright 2020, A B\n\n{licenses.KNOWN['ISC'][0]}", "ISC"), (f"zlib License\n\n(C) 1999 A B\n\n{licenses.KNOWN['Zlib'][0]}", "Zlib")]
    want += [(f"BSD 3-Clause License\n\nCopyright (c) 2001, A\nAll rights reserved.\n\n{bsd}", "BSD-3-Clause"), ("Copyright (c) 2001 A\n\n" + re.sub(r"(?m)^[123]\.", "  *", bsd), "BSD-3-Clause")]
    want += [(own["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2020 A B"), "Apache-2.0"), (own["Apache-2.0"].split("APPENDIX")[0], "Apache-2.0"), (own["GPL-3.0-only"].replace("https:", "http:"), "GPL-3.0-only")]
    want += [(own["GPL-3.0-only"].replace("freedom", "liberty", 1), None), (own["MPL-2.0"] + "\nAnd more.", None), (bsd.split("3. Neither")[0], None)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(want)], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert [(i, got[i].license) for i in range(len(want))] == [(i, name) for i, (_, name) in enumerate(want)]
    assert {r.license for r in got.values() if r.permissive} >= {"MIT", "Apache-2.0", "BSD-3-Clause"} and not any(r.permissive for r in got.values() if (r.license or "").startswith(("GPL", "LGPL", "CC-BY-SA")))


def plain_base(text):
    """The base spans by plain regular expressions."""
    t = text or ""
    luhn = lambda s: sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(s))) % 10 == 0
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m)) <= 15]
    return sorted(out)


def test_base_spans_equal_plain_ones(spark):
    r = random.Random(11)
    parts = ["a", "@", ".", "-", "1", "25", "256", "4111111111111111", "+1 (743) 555-3824", "+", " ", "x@y.z", "é", "..", "1.2.3.4", "b_%", "(", ")", "00", "255"]
    for _ in range(4000):
        t = "".join(r.choice(parts) for _ in range(r.randint(1, 25)))
        assert pii.base_spans(t) == plain_base(t), t
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        assert pii.base_spans(d.text) == plain_base(d.text)


def test_long_runs_take_linear_time():
    for piece in ("a", "1", "1.", "+1 ", "a@", "GB82 WEST ", "'", "-1", "1 "):
        pii.find_pii(piece * 200_000)


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("pay to iban GB82 WEST 1234 5698 7654 32 now", ["iban"]), ("GB82 WEST 1234 5698 7654 33", []), ("my ssn is 536-22-8145", ["ssn"]), ("number 536-22-8145", []),
        ('token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', ["secret"]), ('commit "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', []),
    ],
)
def test_added_spans(text, kinds):
    assert [k for k, *_ in pii.find_pii(text)] == kinds


def test_iban_beside_a_card():
    ibans = [f"AT{98 - int(f'{n:016d}102900') % 97:02d}{n:016d}" for n in range(1904300234573201, 1904300234573301)]
    both = [x for x in ibans if pii.luhn(x[2:])]
    assert both and all(map(pii.mod97, ibans))
    for x in both:
        spaced = " ".join(x[i : i + 4] for i in range(0, 20, 4))
        assert [k[:3] for k in pii.find_pii(f"to iban {spaced} now")] == [("iban", 8, 32), ("card", 10, 32)]
    assert [k for k, *_ in pii.find_pii("my ssn is +1 536-22-8145")] == ["phone"]
    assert [k for k, *_ in pii.find_pii('token = "ab4111111111111111cd41111111111111aa"')] == ["secret", "card"]


def test_added_spans_within_base_ones():
    """An ssn or secret goes where one base span, whichever, holds all of it."""
    parts = ("ssn 123-45-6789 ", "4111 1111 1111 1111 ", "+1 123-45-6789 ", "mail a@b.co ", f"key '{'a1' * 16}' ", "+12 (123) 123-45-6789 ", f'"{"4111111111111111" * 2}" ')
    r = random.Random(1)
    for _ in range(100):
        t = "".join(r.choice(parts) for _ in range(30))
        base = pii.base_spans(t)
        for kind, pattern in (("ssn", pii.SSN), ("secret", pii.SECRET)):
            want = [m.span() for m in pattern.finditer(t) if pii.score(t, *m.span(), kind) >= pii.MIN_SCORE and not any(a <= m.start() and m.end() <= b for a, _, b in base)]
            assert want == [(a, b) for k, a, b, _ in pii.find_pii(t) if k == kind]


def test_pii_query(spark, tmp_path):
    rows = [(1, "mail a.b@c.de or +1 (743) 555-3824", "x"), (2, None, "x"), (None, "", "x"), (3, "é 10.0.0.255 ü 4111 1111 1111 1111", "x"), (3, "é 10.0.0.255 ü 4111 1111 1111 1111", "x")]
    spark.createDataFrame(rows, "doc_id long, text string, pii string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op6_pii(spark, str(tmp_path)).collect()}
    assert got[1].spans == "email:5:13,phone:17:34" and (got[1].n_email, got[1].n_phone) == (1, 1) and got[1].base_sha256 == pii.digest(got[1].spans)
    assert got[3].spans == "ip:2:12,card:15:34" and got[2].spans == "" == got[None].spans and got[2].base_sha256 == pii.digest("")


def test_every_known_text_is_found(spark):
    known = [(name, t) for name, ts in licenses.KNOWN.items() for t in ts if re.search(r"\w", re.sub(licenses.COPYRIGHT_LINE, "", t))]
    docs = spark.createDataFrame([(2 * i, t) for i, (_, t) in enumerate(known)] + [(2 * i + 1, f"Some words.\n  {t}\r\nAnd more.") for i, (_, t) in enumerate(known)], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    for i, (name, t) in enumerate(known):
        assert name in got[2 * i].license.split(","), t
        assert got[2 * i + 1].license is None
        if "\n" not in t.strip():
            assert name in got[2 * i + 1].line_licenses.split(","), t


def test_a_known_line_in_many_equal_rows(spark):
    docs = spark.createDataFrame([(None, "Released under CC BY 4.0.")] * 50 + [(1, "Released under CC BY 4.0."), (1, "x")], "doc_id long, text string").repartition(7)
    got = sorted(((r.doc_id, r.line_licenses, r.license, r.permissive) for r in licenses.scan_licenses(docs).collect()), key=repr)
    assert got == sorted([(None, "CC-BY-4.0", "CC-BY-4.0", True)] * 50 + [(1, "CC-BY-4.0", "CC-BY-4.0", True), (1, "", None, None)], key=repr)
