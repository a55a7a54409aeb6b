from dunlin.llm.licenses import KNOWN, SPELLINGS, TEXTS, known_digests, scan_licenses
from tests.llm.common import ODD, docs_of

MIT, ZLIB = KNOWN[0][1], dict(KNOWN)["Zlib"]


def test_variants_of_whole_texts_are_found(spark):
    texts = ["Copyright (c) 2020 Someone\nAll rights reserved.\n\n" + MIT, MIT.upper().replace(",", " -- "), MIT + " more", MIT.replace("\n", " "),
             ZLIB.replace("acknowledgment", "acknowledgement"), "© 2001 X\n" + MIT.replace("sublicense", "sub-licence"),
             "text\nreleased under the mit licence\nReleased under the MIT License!\nLicensed under the Apache License Version 2.0", "Released under the MIT License.", *ODD]
    got = {r.doc_id: r for r in scan_licenses(docs_of(spark, texts), known_digests(spark)).collect()}
    assert [got[i].license_id for i in range(8)] == ["MIT", "MIT", None, "MIT", "Zlib", "MIT", None, "MIT"]
    assert (got[6].notices, got[6].n_notices) == ("Apache-2.0,MIT", 3)
    assert (got[7].notices, got[7].n_notices) == ("MIT", 1)
    assert len(got) == len(texts) and all(got[i].license_id is None and got[i].n_notices == 0 for i in range(8, len(texts)))
    assert got[8].text_digest == got[9].text_digest == got[10].text_digest


def test_own_table_repeats_and_empty(spark):
    known = known_digests(spark, [("X", "My own\nnotice"), ("Y", "my own notice"), ("Z", "")])
    got = scan_licenses(docs_of(spark, ["MY OWN notice.", "", "my own notice"], [1, 2, 1]), known).collect()
    assert {(r.doc_id, r.license_id, r.notices, r.n_notices) for r in got} == {(1, "X", "X", 2), (2, None, "", 0)}
    assert scan_licenses(docs_of(spark, []), known).count() == 0
    assert scan_licenses(docs_of(spark, ["a"]), known.limit(0)).first().license_id is None


def test_spellings_do_not_chain():
    assert not {b for _, b in SPELLINGS} & {a for a, _ in SPELLINGS}


def test_full_texts_and_titles_are_known(spark):
    files = {p.stem: p.read_text(encoding="utf-8") for p in TEXTS.glob("*.txt")}
    assert {"Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "MPL-2.0", "CC0-1.0", "Unlicense"} <= set(files)
    full = dict((n, t) for n, t in reversed(KNOWN) if "\n" in t)
    apache, gpl = files["Apache-2.0"], files["GPL-3.0-only"]
    cases = [*((n, t) for n, t in files.items()), ("MIT", "MIT License\n\nCopyright (c) 2020 Someone\n\n" + MIT), ("MIT", "The MIT License (MIT)\n" + MIT),
             ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, X\nAll rights reserved.\n\n" + full["BSD-3-Clause"]),
             ("ISC", "ISC License\n\nCopyright (c) 2020, X\n\n" + full["ISC"]), ("Zlib", "zlib License\n\n(C) 2001 X\n" + ZLIB), ("Unlicense", "The Unlicense\n" + files["Unlicense"]),
             ("Apache-2.0", apache[:apache.index("APPENDIX")]), ("Apache-2.0", apache[apache.index("TERMS AND"):]), ("GPL-3.0-only", gpl[:gpl.index("How to Apply")]), (None, gpl + " and more")]
    got = {r.doc_id: r.license_id for r in scan_licenses(docs_of(spark, [t for _, t in cases]), known_digests(spark)).collect()}
    assert [got[i] for i in range(len(cases))] == [n for n, _ in cases]
