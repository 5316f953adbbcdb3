from __future__ import annotations

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import licenses

MACHINE = licenses.automaton({p: ("base", label, len(p) + 1) for p, label in licenses.BASE.items()})
PART = st.sampled_from(["MIT", "license", "Apache", "general", "public", "GNU", "x", "é", "-", "\n", ".", "1"])


@settings(max_examples=200, deadline=None)
@given(st.lists(PART, max_size=30).map(" ".join))
def test_base_columns(text):
    got = licenses.scan_text(text.encode(), MACHINE, licenses.ALLOWED)
    assert got[:5] == brute.license_base(text, licenses.BASE)


@pytest.mark.parametrize(
    ("text", "order"),
    [
        ("MIT", ["mit"]),
        ("MIT OR Apache-2.0 AND ISC", ["mit", "apache-2.0", "isc", "and", "or"]),
        ("(MIT OR Apache-2.0) AND ISC", ["mit", "apache-2.0", "or", "isc", "and"]),
        ("GPL-2.0 WITH Classpath-exception-2.0 OR MIT", ["gpl-2.0", "classpath-exception-2.0", "with", "mit", "or"]),
        ("", None), ("MIT AND", None), ("MIT ISC", None), ("(MIT", None), ("MIT)", None), ("OR MIT", None), ("MIT & ISC", None),
    ],
)
def test_shunting_yard(text, order):
    assert licenses.postfix(text) == order


def test_evaluation():
    assert licenses.evaluate("GPL-3.0-only") == (False, {"gpl"})
    assert licenses.evaluate("GPL-3.0-only OR MIT") == (True, {"gpl", "mit"})
    assert licenses.evaluate("GPL-3.0-only AND MIT") == (False, {"gpl", "mit"})
    assert licenses.evaluate("GPL-2.0 WITH Classpath-exception-2.0") == (True, {"gpl"})
    assert licenses.evaluate("GPL-2.0 WITH Unheard-of") == (False, {"gpl"})
    assert licenses.evaluate("(MIT) WITH Classpath-exception-2.0") is not None


def test_tag_and_notice(spark):
    rows = [
        (1, "// SPDX-License-Identifier: MIT OR GPL-2.0-only */\nint x;"),
        (2, "/* spdx-license-identifier: GPL-3.0 AND */"),
        (3, "Licensed under the Apache License, Version 2.0. All rights reserved."),
        (4, "Licensed under CC BY-NC 4.0. Text: CC BY 4.0. GNU Lesser General Public License"),
        (5, "Licensed under CC BY-NC-SA 4.0."),
    ]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].labels, got[1].score, got[1].n_expressions, got[1].usable) == ("gpl,mit", 1.0, 1, True)
    assert (got[2].n_malformed, got[2].usable) == (1, False)
    assert (got[4].base_labels, got[4].labels) == ("gpl", "cc-by,cc-by-nc,gpl,lgpl") and got[5].labels == "cc-by-nc"
    assert (got[3].base_labels, got[3].labels, got[3].usable) == ("apache", "apache,proprietary", False)


def test_odd_rows(odd):
    got = licenses.scan(odd).collect()
    assert len(got) == odd.count()
    null = next(r for r in got if r.doc_id == 1)
    assert (null.n_words, null.n_base, null.first_word, null.labels, null.score) == (0, 0, None, "", 0.0)
    assert [r.base_labels for r in got if r.doc_id == 8] == ["mit", "mit"]


def test_empty_table(none):
    assert licenses.scan(none).collect() == []
