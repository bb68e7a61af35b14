"""License scans: alignment against brute force, planted notices."""

import random
import re

import numpy as np

from logsieve.llm.licenses import TEMPLATES, find_template, patience_alignment, scan_licenses, words_of


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_is_a_common_subsequence():
    rnd = random.Random(3)
    for _ in range(400):
        a = rnd.choices("abcdefghij", k=rnd.randint(0, 14))
        b = rnd.choices("abcdefghij", k=rnd.randint(0, 14))
        pairs = patience_alignment(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
        assert len(pairs) <= lcs(a, b)
    for _ in range(200):  # all words unique: the longest increasing subsequence is the optimum
        a, b = (rnd.sample(range(30), rnd.randint(0, 20)) for _ in "ab")
        shared_a, shared_b = [x for x in a if x in b], [x for x in b if x in a]
        assert len(patience_alignment(shared_a, shared_b)) == lcs(a, b)
    assert len(patience_alignment(list("abcabc") + ["x"] + list("abc"), list("abcabc") + ["y"] + list("abc"))) == 9


def _scan(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, license string")
    return scan_licenses(docs, **options)


def test_planted_notices(spark):
    rnd = random.Random(1)
    filler = [f"w{i}" for i in range(500)] + ["the", "of", "and", "to"]
    rows, want = [], []
    for k, (name, text) in enumerate(TEMPLATES.items()):
        words = text.split()
        changed = [w for i, w in enumerate(words) if i != len(words) // 2] if len(words) > 20 else words
        body = rnd.choices(filler, k=300)
        rows.append((k, " ".join(body + changed + body + [w.upper() for w in words])))
        want += [(k, name)] * 2
        rows.append((100 + k, " ".join(body)))
    got = _scan(spark, rows).collect()
    assert sorted((r.doc_id, r.license) for r in got) == sorted(want)
    for r in got:
        assert 0.8 <= r.coverage <= 1 and r.matched_words <= r.template_words
        found = words_of(dict(rows)[r.doc_id])[r.start_word : r.end_word]
        assert lcs(found, words_of(TEMPLATES[r.license])) >= r.matched_words


def test_adjacent_repeats_and_sister_licenses(spark):
    line = TEMPLATES["CC-BY-NC-4.0-line"]
    got = _scan(spark, [(1, f"{line}\n{line} {line}"), (2, "Licensed under CC BY-SA 4.0"), (3, TEMPLATES["Apache-2.0-notice"])]).collect()
    assert sorted((r.doc_id, r.license, r.start_word, r.coverage) for r in got) == [
        (1, "CC-BY-NC-4.0-line", 0, 1.0), (1, "CC-BY-NC-4.0-line", 5, 1.0), (1, "CC-BY-NC-4.0-line", 10, 1.0),
        (2, "CC-BY-SA-4.0-line", 0, 1.0), (3, "Apache-2.0-notice", 0, 1.0),
    ]


def test_odd_rows(spark):
    line = "Released under the MIT License."
    rows = [(None, line), (1, None), (2, ""), (3, "..."), (4, line), (4, line), (5, "MIT License"), (6, "x " * 60_000 + line)]
    got = _scan(spark, rows).collect()
    assert sorted(str(r.doc_id) for r in got) == ["4", "4", "6", "None"]
    assert next(r for r in got if r.doc_id == 6).start_word == 60_000
    assert _scan(spark, []).count() == 0
    assert _scan(spark, rows, templates={"none": "", "own": "x x x"}, share=1.0).where("doc_id = 6").count() == 20_000


def test_license_lines_of_the_given_documents(spark):
    """What a plain text search finds in the table, the scan reports, and no more."""
    lines = {
        "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
        "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
        "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
        "MIT-line": "Released under the MIT License.",
        "all-rights-reserved-line": "All rights reserved.",
    }
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = [
        (r.doc_id, name) for r in docs.select("doc_id", "text").collect()
        for name, line in lines.items() for _ in re.findall(re.escape(line), r.text or "", re.IGNORECASE)
    ]
    assert {name for _, name in want} == set(lines)
    got = scan_licenses(docs).collect()
    assert sorted((r.doc_id, r.license) for r in got) == sorted(want)
    long_ = _scan(spark, [(1, TEMPLATES["all-rights-reserved"])]).collect()
    assert [r.license for r in long_] == ["all-rights-reserved"]


def _find(words, template):
    return find_template(words, template, np.array([w in template for w in words], dtype=np.int64), 0.8)


def test_edited_notice_beside_an_exact_one(spark):
    text = "Released under an MIT License. Released under the MIT License."
    got = sorted(tuple(r)[1:5] for r in _scan(spark, [(1, text)]).collect())
    assert got == [("MIT-line", 0, 5, 4), ("MIT-line", 5, 10, 5)]
    notice = [f"t{i}" for i in range(78)]
    edited = [*notice[:20], "x", *notice[21:]]
    assert _find(edited + notice, notice) == [(0, 78, 77), (78, 156, 78)]
    assert _find(notice + edited + edited + notice, notice) == [
        (0, 78, 78), (78, 156, 77), (156, 234, 77), (234, 312, 78),
    ]
    for name, line in TEMPLATES.items():  # words of the template before it cut nothing off
        words = words_of(line)
        assert _find(["x", *words[1:3], "y", *words], words)[-1][1:] == (4 + len(words), len(words)), name


def test_search_against_every_start():
    rnd = random.Random(5)
    for _ in range(400):
        template = rnd.choices("abcdefghij", k=rnd.randint(3, 10))
        words = []
        for _ in range(rnd.randint(1, 4)):
            copy = list(template)
            for _ in range(rnd.choice([0, 0, 1, 2])):
                at = rnd.randrange(len(copy))
                copy[at : at + rnd.choice([0, 1])] = [rnd.choice("abcdefghijxyz")] * rnd.choice([0, 1])
            words += copy + rnd.choices("abcxyz", k=rnd.choice([0, 0, 1, 3]))
        m = len(template)
        need, width = -(-m * 4 // 5), m + -(-m // 4)
        most = [0] * (len(words) + 1)  # the most words that occurrences apart match in words[:end]
        for end in range(1, len(words) + 1):
            most[end] = most[end - 1]
            for start in range(max(0, end - width), end):
                n = len(patience_alignment(words[start:end], template))
                if n >= need:
                    most[end] = max(most[end], most[start] + n)
        got = _find(words, template)
        assert sum(n for _, _, n in got) == most[-1], (words, template)
        assert all(a[1] <= b[0] for a, b in zip(got, got[1:]))
        assert all(n >= need and e - s <= width for s, e, n in got)


def test_other_words_between_those_of_a_notice(spark):
    mit, notice = "Released under the terms and conditions of the MIT License", TEMPLATES["Apache-2.0-notice"].split()
    apart = [w for k, w in enumerate(notice) for w in ([w, "x"] if k % 3 == 0 else [w])]  # a third more words
    rows = [(1, mit), (2, " ".join(apart)), (3, f"{mit}. {mit}!"), (4, "All x rights y reserved."),
            (5, "Released under the MIT" + " x" * 9 + " License, released"), (6, "released " + "x " * 10 + "under MIT license")]
    got = sorted(tuple(r)[:5] for r in _scan(spark, rows).collect())
    assert got == [
        (1, "MIT-line", 0, 10, 5), (2, "Apache-2.0-notice", 0, len(words_of(" ".join(apart))), 79),
        (3, "MIT-line", 0, 10, 5), (3, "MIT-line", 10, 20, 5), (4, "all-rights-reserved-line", 0, 5, 3),
        (5, "MIT-line", 0, 4, 4),
    ]
    assert _scan(spark, rows, between=9).where("doc_id in (5, 6)").count() == 2


def test_any_number_of_templates(spark):
    """Two hundred templates of their own words, each planted once, beside common words."""
    templates = {f"t{k:03d}": f"notice {k} of holder{k} permits use{k} with credit{k} only" for k in range(200)}
    rows = [(k, f"some words before {t} and after") for k, t in enumerate(templates.values())]
    docs = spark.createDataFrame([*rows, (900, "no notice at all"), (901, None)], "doc_id long, text string")
    got = scan_licenses(docs, templates, share=1.0).collect()
    assert sorted((r.doc_id, r.license, r.start_word, r.end_word) for r in got) == [
        (k, name, 3, 3 + len(t.split())) for k, (name, t) in enumerate(templates.items())]
    assert scan_licenses(docs, {}).collect() == []
