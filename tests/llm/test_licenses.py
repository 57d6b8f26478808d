import re

import pytest

from basketry.llm import licenses
from tests.llm.conftest import AWKWARD, prose

MIT = licenses.KNOWN["MIT"][3]
MIT_FILE = f"MIT License\n\nCopyright (c) 2020 Somebody\n\n{MIT}\n"
NAMES = {MIT: "MIT", licenses.KNOWN["BSD-3-Clause"][2]: "BSD-3-Clause", licenses.KNOWN["BSD-2-Clause"][2]: "BSD-2-Clause", licenses.KNOWN["Zlib"][0]: "Zlib"}


def wrapped(text, width=60, mark=""):
    return "\n".join(mark + line for line in re.findall(rf".{{1,{width}}}(?: |$)", text))


def scanned(df, *more):
    return sorted(map(tuple, licenses.scan(df, *more).collect()))


def words(text):
    """An own form: words of the lines that name no holder, spellings put right one word at a time."""
    kept = []
    for line in text.lower().split("\n"):
        bare = line.lstrip(" \t/*#;-")
        if re.match(r"all rights reserved\.?[ \t]*$|©|(copyright|\(c\)).*[0-9]{4}|copyright[ \t]*(\(c\)|©|:|[\[<{]|by )", bare):
            continue
        kept += re.findall(r"[^\W_]+", re.sub(r"^\(?([0-9]{1,2}|[a-z])[.)][ \t]+", "", bare))
    joined, i = [], 0
    while i < len(kept):
        if i + 1 < len(kept) and (kept[i], kept[i + 1]) in {("sub", "license"), ("non", "commercial"), ("per", "cent")}:
            joined.append(kept[i] + kept[i + 1])
            i += 2
        else:
            one = {"licence": "license", "organisation": "organization", "merchantibility": "merchantability", "fulfil": "fulfill", "acknowledgement": "acknowledgment"}
            joined.append(one.get(kept[i], kept[i]))
            i += 1
    return joined


def brute(doc_id, text, known):
    """Known texts as (words, license, found inside documents too), by plain comparison of word lists."""
    text = text or ""
    found = [(doc_id, "text", -1, name) for form, name, _ in known if words(text) == form]
    lines = text.split("\n")
    found += [(doc_id, "line", i, name) for i, line in enumerate(lines) for form, name, _ in known if len(lines) > 1 and words(line) == form]
    whole = words(text)
    return found + [(doc_id, "passage", -1, name) for form, name, inside in known if inside
                    for i in range(len(whole) - len(form) + 1) if whole[i:i + len(form)] == form]


def test_spelling_case_punctuation_and_copyright_do_not_matter(docs):
    rows = [
        (1, "Copyright (c) 2020 Somebody\n\n" + MIT.upper().replace("MERCHANTABILITY", "MERCHANTIBILITY"), "en", "s", 0),
        (2, wrapped(MIT), "en", "s", 0),
        (3, prose(1, 40) + "\n  Released under the MIT  Licence\n© 2021 me\n" + prose(2, 20), "en", "s", 0),
        (4, MIT + " and more", "en", "s", 0), (5, "Licensed under the Apache License, Version 2.0.", "en", "s", 0),
        (6, prose(1, 3) + " Released under the MIT License.", "en", "s", 0), (6, "released under the mit license", "en", "s", 0), (6, "released under the mit license", "en", "s", 0)]
    assert scanned(docs(rows + AWKWARD, ("digest", "license", "line", "words", "form"))) == [
        (1, "line", 2, "MIT"), (1, "passage", -1, "MIT"), (1, "text", -1, "MIT"), (2, "passage", -1, "MIT"), (2, "text", -1, "MIT"), (3, "line", 1, "MIT"),
        (4, "passage", -1, "MIT"), (5, "text", -1, "Apache-2.0"), (6, "text", -1, "MIT"), (6, "text", -1, "MIT")]


def test_published_forms_are_found_and_near_misses_are_not(docs):
    bsd3, zlib = licenses.KNOWN["BSD-3-Clause"][2], licenses.KNOWN["Zlib"][0]
    numbered = bsd3.replace("Redistributions of", "\n1. Redistributions of").replace("Redistributions in", "\n2. Redistributions in").replace("Neither", "\n3. Neither")
    rows = [
        (1, MIT_FILE, "en", "s", 0), (2, "/*\n" + wrapped(MIT_FILE.replace("\n", " \n "), 70, " * ") + "\n */\nint main() {}", "en", "s", 0),
        (3, f"# Tool\n\n{prose(1, 60)}\n\n## License\n\n{wrapped(MIT_FILE)}\n\n## Thanks\n\n{prose(2, 60)}", "en", "s", 0),
        (4, f"Copyright 2019, The Authors\nAll rights reserved.\n\n{numbered}", "en", "s", 0), (5, wrapped(bsd3, 40, "# "), "en", "s", 0),
        (6, zlib.replace("acknowledgment", "acknowledgement").replace("The origin", "\n1. The origin"), "en", "s", 0),
        (7, f"{prose(3, 9)}\n{MIT}\n{prose(4, 9)}\n{wrapped(MIT, 33)}\n{wrapped(bsd3)}", "en", "s", 0),
        # One word changed, one left out, one more inside, the end missing, first and last word grown.
        (10, MIT_FILE.replace("publish", "print"), "en", "s", 0), (11, MIT_FILE.replace(" sell", ""), "en", "s", 0),
        (12, MIT_FILE.replace("merge", "merge and mix"), "en", "s", 0), (13, MIT_FILE[:-40], "en", "s", 0), (14, f"x{MIT[:-1]}x", "en", "s", 0),
        (15, "Permission is hereby granted, free of charge, to any person obtaining " * 3000, "en", "s", 0)]
    known = [(words(t), n, True) for t, n in NAMES.items()] + [(words(f"{title}\n{t}"), n, False) for t, n in NAMES.items() for title in licenses.TITLES[n]]
    got = scanned(docs(rows))
    assert got == sorted(x for r in rows for x in brute(r[0], r[1], known))
    assert {g[0] for g in got} == {r[0] for r in rows if r[0] < 10} and sum(g[0] == 7 and g[3] == "MIT" for g in got) == 3  # two passages, one line


def test_long_texts_by_their_measures(docs, spark):
    text = prose(5, 4000) + " Organisation fulfil licence. " + prose(6, 3000)
    form = spark.createDataFrame([("own", " ".join(words(text)))], "license string, words string")
    (m,) = licenses.measures(form).collect()
    long = {"own": ((m["first"], m["last"], m["length"], m["digest"]),)}
    rows = [(1, text, "en", "s", 0), (2, prose(1, 50) + "\n" + wrapped(text) + "\n" + prose(2, 50), "en", "s", 0), (3, text.replace("fulfil", "full"), "en", "s", 0),
            (4, text[:-3], "en", "s", 0)]
    assert scanned(docs(rows), {"x": ("nothing of the kind",)}, {}, long) == [(1, "passage", -1, "own"), (1, "text", -1, "own"), (2, "passage", -1, "own")]


@pytest.mark.parametrize("name,file", [("Apache-2.0", "Apache-2.0"), ("GPL-3.0-only", "GPL-3"), ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0")])
def test_full_licenses(docs, name, file):
    try:
        text = open(f"/usr/share/common-licenses/{file}").read()
    except OSError:
        pytest.skip("no license texts on this machine")
    got = scanned(docs([(1, text, "en", "s", 0), (2, prose(1, 9) + "\n\n" + re.sub(r"(?m)^", "// ", text), "en", "s", 0), (3, text.replace("any", "an"), "en", "s", 0)]))
    rows = {i: [g[1:] for g in got if g[0] == i and g[3] == name] for i in (1, 2, 3)}
    assert ("text", -1, name) in rows[1] and rows[1][:-1] == rows[2]
    assert len(rows[3]) < len(rows[2]) and all(scope == "passage" for scope, *_ in rows[3])  # at most the header that some texts quote


def test_same_rows_as_sql(docs, spark, small):
    import duckdb

    table = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    more = [(10_000 + i, t, "en", "s", 0) for i, t in enumerate([MIT_FILE, wrapped(MIT_FILE, 50, "// "), MIT + "\n" + wrapped(MIT) + " x", "non\ncommercial per cent sub-licence"])]
    both = table.unionByName(docs(more + AWKWARD)).select("doc_id", "text")
    with duckdb.connect() as con:
        documents = both.toArrow()  # noqa: F841 (read by name)
        expected = sorted(con.execute("WITH documents AS (SELECT * FROM documents) " + licenses.SCAN_SQL.lstrip().replace("WITH texts", ", texts", 1)).fetchall(), key=str)
    assert sorted(map(tuple, licenses.scan(both).collect()), key=str) == expected and len(expected) > 8


def test_other_known_texts_and_empty_tables(docs, empty):
    assert licenses.scan(empty).count() == 0
    rows = [(1, "You may do as you like!", "en", "s", 0), (2, "Released under the MIT License.", "en", "s", 0)]
    assert scanned(docs(rows), {"own": ("you may do as you like",)}, {}, {}) == [(1, "text", -1, "own")]


def test_no_python_on_the_executors(docs):
    assert not re.search("Python|Pandas|Arrow", licenses.scan(docs(AWKWARD))._jdf.queryExecution().toString())
