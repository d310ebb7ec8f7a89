"""Ordinary licence files: wrapped, commented, with and without title and copyright statements."""

import textwrap

import pytest

from cohortmill.llm.licenses import KNOWN, TITLED, find_licenses

ISC = """ISC License

Copyright (c) 2004-2010, Somebody <s@example.org>

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


def found(spark, texts):
    rows = find_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    return {(r.doc_id, r.unit, r.part, r.license) for r in rows}


def test_a_real_file(spark):
    body = ISC.split("\n\n", 2)[2]
    windows = ISC.replace("\n", "\r\n")
    commented = "".join(f" * {line}\n" for line in ISC.splitlines())
    got = found(spark, [ISC, body, windows, commented, "prose before\n\n" + ISC])
    assert got == {(i, "text", 0, "ISC") for i in range(4)}


@pytest.mark.parametrize("width", [40, 80, 10_000])
def test_every_whole_text_wrapped_with_and_without_title(spark, width):
    texts, want = [], set()
    for name, body, titles in TITLED:
        for title in ("", *titles):
            for statement in ("", "Copyright (c) 2020 A. Holder", "Copyright © 1999-2003 by X\nAll rights reserved.", "(C) Copyright 2001 Z"):
                parts = [p for p in (title, statement, textwrap.fill(body, width, break_long_words=False, break_on_hyphens=False)) if p]
                want.add((len(texts), name))
                texts.append("\n\n".join(parts))
    got = found(spark, texts)
    assert {(i, name) for i, unit, _, name in got if unit == "text"} == want


def test_notices_in_source_files(spark):
    notices = [(name, body) for name, body in KNOWN if name.startswith(("MPL", "GPL")) and len(body) > 100 or body.startswith("Licensed under the Apache License, Version 2.0 (")]
    texts = []
    for _, body in notices:
        lines = textwrap.wrap(body.replace("http://", "https://"), 70, break_long_words=False, break_on_hyphens=False)
        texts.append("/*\n" + "".join(f" * {line}\n" for line in lines) + " */\n\nint main() {}\n")
    got = found(spark, texts)
    assert {(i, name) for i, unit, part, name in got if unit == "paragraph" and part == 0} == {(i, name) for i, (name, _) in enumerate(notices)}
    assert {name for name, _ in notices} == {"MPL-2.0", "GPL-2.0-or-later", "GPL-3.0-or-later", "Apache-2.0"}


def test_other_texts_and_parts(spark):
    texts = [
        "Copyright 2020 X", "copyright notice and this permission notice", None, "", "\n\n", "All rights reserved.",
        "a\n\n\n\nReleased under the MIT License.\n-----\n\n Licensed under CC BY 4.0.", "x" * 200_000,
    ]
    assert found(spark, texts) == {
        (6, "line", 4, "MIT"), (6, "paragraph", 1, "MIT"), (6, "line", 7, "CC-BY-4.0"), (6, "paragraph", 2, "CC-BY-4.0"),
    }
