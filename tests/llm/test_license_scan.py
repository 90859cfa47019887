from __future__ import annotations

from pathlib import Path

import pytest

from rateflow.llm import license_scan
from rateflow.llm.oracle import ORACLE_SQL
from rateflow.llm.queries import REGISTRY

BSD = next(text for name, text in license_scan.KNOWN_TEXTS if name == "BSD-3-Clause")


def test_query_matches_sql(spark, duck, same_rows, sf_dir):
    name = "op10_license_scans"
    same_rows(REGISTRY[name](spark, sf_dir), duck.sql(ORACLE_SQL[name]))


@pytest.mark.parametrize(
    ("text", "license_", "notices"),
    [
        (None, None, ""),
        ("", None, ""),
        ("nothing here", None, ""),
        ("Copyright (c) 2020 Somebody\n\n" + BSD.upper().replace(", ", ",\n   "), "BSD-3-Clause", ""),
        (BSD + " And more.", None, ""),
        ("licensed under the apache licence, v2.0", "Apache-2.0", "Apache-2.0"),
        ("one\nReleased under the MIT License!\ntwo\nReleased under the MIT Licence.", None, "MIT"),
        ("All rights reserved.\nReleased under the MIT License.", None,
         "LicenseRef-all-rights-reserved,MIT"),
        ("word " * 40000, None, ""),
    ],
)
def test_texts(spark, documents, text, license_, notices):
    row = license_scan.scan(spark, documents([(1, text)])).first()
    assert (row["license"], row["notices"], row["n_rows"]) == (license_, notices, 1)


def test_repeated_rows_null_ids_and_clashing_columns(spark, documents):
    docs = documents([(1, "All rights reserved."), (1, "All rights reserved."), (None, "x")])
    docs = docs.selectExpr("*", "'a' AS license", "'b' AS digest", "1 AS n_rows")
    found = {r["doc_id"]: (r["n_rows"], r["n_notices"]) for r in license_scan.scan(spark, docs).collect()}
    assert found == {1: (2, 1), None: (1, 0)}


def test_empty_table(spark, documents):
    assert license_scan.scan(spark, documents([]).limit(0)).count() == 0


def test_runs_no_python_on_executors(spark, documents):
    plan = license_scan.scan(spark, documents([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


ISC_FILE = """ISC License

Copyright (c) 2012, Somebody <me@here.com>

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
MIT = next(text for name, text in license_scan.KNOWN_TEXTS[1:] if name == "MIT")


def test_whole_licence_files(spark, documents):
    rows = [
        ("ISC", ISC_FILE),
        ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, Somebody\n\n" + BSD),
        ("BSD-3-Clause", "BSD 3-Clause License\nCopyright 2020 X\nAll rights reserved.\n\n" + BSD),
        ("MIT", "The MIT License (MIT)\n\nCopyright (c) 2020 Somebody\n\n" + MIT),
    ]
    folder = Path(license_scan.__file__).parent / "licenses"
    whole = {path.stem: path.read_text() for path in folder.glob("*.txt")}
    assert {"Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "MPL-2.0", "CC0-1.0",
            "Unlicense"} <= set(whole)
    rows += whole.items()
    rows.append(("Apache-2.0", whole["Apache-2.0"].split("   APPENDIX:")[0]))
    rows.append((None, whole["GPL-3.0-only"] + "\nAnd more."))
    found = license_scan.scan(spark, documents([(i, text) for i, (_, text) in enumerate(rows)]))
    assert {r["doc_id"]: r["license"] for r in found.collect()} == {
        i: name for i, (name, _) in enumerate(rows)
    }


@pytest.mark.parametrize("parts", [("copyright", "owner"), ("non-", "commercial"), ("sub", "license"), ("v", "3")])
def test_long_texts_have_one_digest_however_they_are_wrapped(spark, documents, parts):
    rows = [(1, "many words " * 30_000 + " ".join(parts)), (2, "many words " * 30_000 + "\n".join(parts))]
    found = license_scan.scan(spark, documents(rows)).collect()
    assert len(found) == 2 and len({r["digest"] for r in found}) == 1
