"""License scans by patience alignment of documents with license templates."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsieve.llm.common import each

# License notices, as their licenses word them.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS '
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."
    ),
    "BSD-line": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-line": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."
    ),
    "MIT-line": "Released under the MIT License.",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "all-rights-reserved": "Copyright. All rights reserved. No part of this work may be reproduced without permission.",
    "all-rights-reserved-line": "All rights reserved.",
}

#: Other words that may stand between those of a template: half as many as it
#: has, and of a short one so many.
BETWEEN = 8

_WORD = re.compile(r"[^\W_]+(?:[.\-'/][^\W_]+)*")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def patience_alignment(a: Sequence[str], b: Sequence[str]) -> list[tuple[int, int]]:
    """Matched places (i, j), ascending in both, of two word sequences.

    Equal words at both ends of a range match. The words that occur once in
    either side of what is left are anchors; of these the longest increasing
    subsequence is kept, and the gaps between the anchors are aligned in the
    same way, until a gap has no anchor.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        low_a, high_a, low_b, high_b = todo.pop()
        while low_a < high_a and low_b < high_b and a[low_a] == b[low_b]:
            out.append((low_a, low_b))
            low_a, low_b = low_a + 1, low_b + 1
        while low_a < high_a and low_b < high_b and a[high_a - 1] == b[high_b - 1]:
            high_a, high_b = high_a - 1, high_b - 1
            out.append((high_a, high_b))
        if low_a >= high_a or low_b >= high_b:
            continue
        count_a, count_b = Counter(a[low_a:high_a]), Counter(b[low_b:high_b])
        place = {w: j for j, w in enumerate(b[low_b:high_b], low_b) if count_b[w] == 1}
        pairs = [(i, place[w]) for i, w in enumerate(a[low_a:high_a], low_a) if count_a[w] == 1 and w in place]
        anchors = _increasing(pairs)
        out += anchors
        last_a, last_b = low_a, low_b
        for i, j in [*anchors, (high_a, high_b)] if anchors else ():
            todo.append((last_a, i, last_b, j))
            last_a, last_b = i + 1, j + 1
    return sorted(out)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence ascending in j of pairs ascending in i, by piles."""
    tops: list[int] = []
    last: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        back.append(last[pile - 1] if pile else -1)
        tops[pile : pile + 1] = [j]
        last[pile : pile + 1] = [k]
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def find_template(
    words: Sequence[str], template: Sequence[str], inside: np.ndarray, share: float, between: int | None = None
) -> list[tuple]:
    """(start, end, matched) of every place where the alignment covers `share`
    of the template; `inside` marks the words that the template has.

    An occurrence is at most `between` words longer than the template, a
    quarter of it if None. It begins with one of the template's first words
    and ends with one of its last, else too few are left to match. Every such span whose longest common
    subsequence with the template is long enough is a candidate; of those that
    overlap, the ones apart with most matched words in all are aligned.
    """
    m = len(template)
    need = max(1, -(-m * round(share * 1000) // 1000))
    width = m + (-(-m // 4) if between is None else between)
    if need > m or len(words) < need:
        return []
    sums = np.r_[0, np.cumsum(inside)]
    held = sums[np.minimum(np.arange(len(words)) + width, len(words))] - sums[:-1]
    heads, tails, places = set(template[: m - need + 1]), set(template[need - 1 :]), {}
    for j, w in enumerate(template):
        places[w] = places.get(w, 0) | 1 << j
    out, group, reach = [], [], 0
    for start in np.flatnonzero((held >= need) & (inside > 0)).tolist():
        if words[start] not in heads:
            continue
        if start >= reach:
            out += _most_matched(words, template, group, need)
            group = []
        # Zeros of `row` are the length of the common subsequence so far.
        row = full = (1 << m) - 1
        for end, w in enumerate(words[start : start + width], start + 1):
            if at := places.get(w):
                both = row & at
                row = (row + both | row - both) & full
                if w in tails and (common := m - row.bit_count()) >= need:
                    group.append((start, end, common))
                    reach = max(reach, end)
    return out + _most_matched(words, template, group, need)


def _most_matched(words: Sequence[str], template: Sequence[str], spans: list[tuple], need: int) -> list[tuple]:
    """Of spans (start, end, common), those apart with most matched words in
    all, then of fewest words, then first; as (start, end, matched) of their
    alignments. `common` is the most that an alignment can match: only spans
    that are chosen by it are aligned, until all that are chosen have been."""
    spans = sorted(spans, key=lambda s: (s[1], s[0]))
    ends = [end for _, end, _ in spans]
    before = [bisect_right(ends, start) for start, _, _ in spans]
    most, aligned, rounds = [common for *_, common in spans], {}, 0
    while True:
        total = [0]
        for k, (start, end, _) in enumerate(spans):
            take = total[before[k]] + most[k] * (len(words) + 1) - (end - start) if most[k] else 0
            total.append(max(take, total[-1]))
        chosen, k = [], len(spans)
        while k:
            if total[k] == total[k - 1]:
                k -= 1
            else:
                chosen.append(k - 1)
                k = before[k - 1]
        rounds += 1
        short = False
        for k in chosen if rounds < 4 else range(len(spans)):
            if k not in aligned:
                start, end, _ = spans[k]
                pairs = patience_alignment(words[start:end], template)
                found = len(pairs) if len(pairs) >= need else 0
                aligned[k] = (start + pairs[0][0], start + pairs[-1][0] + 1, found) if found else None
                short |= found < most[k]
                most[k] = found
        if not short:
            return [aligned[k] for k in reversed(chosen)]


def best_apart(found: list[tuple]) -> list[tuple]:
    """Of occurrences that overlap, the one with most matched words, then of
    the best coverage, then first by name; in order of place."""
    kept: list[tuple] = []
    for row in sorted(found, key=lambda r: (-r[4], r[5], r[1], r[2])):
        if all(row[3] <= k[2] or k[3] <= row[2] for k in kept):
            kept.append(row)
    return sorted(kept, key=lambda r: r[2])


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES, share: float = 0.8,
    id_col: str = "doc_id", text_col: str = "text", between: int = BETWEEN,
) -> DataFrame:
    """One row for each occurrence of a license text: (id_col, license,
    start_word, end_word, matched_words, template_words, coverage).

    Words are compared in lower case without punctuation around them. Places
    are word numbers of the whole text; coverage is the share of the
    template's words that the patience alignment matches, `share` or more. An
    occurrence may be longer than its template by half as many words, and by
    `between` at least.
    Of occurrences that overlap only the one with most matched words stays, so
    a short notice inside a long one, or a sister license that differs in a
    word, is not reported beside it. Null and empty texts have no occurrence; repeated rows give their
    rows each; other columns are ignored; an empty table, or no template, gives
    no row. Templates are parameters, any number of them, and are sent with
    the task; there is no shuffle.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    wanted = {name: words_of(t) for name, t in templates.items() if words_of(t)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: dict[str, int] = {}
        numbers = [[vocabulary.setdefault(w, len(vocabulary)) for w in words] for words in wanted.values()]
        # a row per template: which words it has; the last column is for all others
        has = np.zeros((len(wanted), len(vocabulary) + 1), dtype=bool)
        for row, own in zip(has, numbers):
            row[own] = True
        for batch in batches:
            rows, id_type = [], batch.column("id").type
            for name, text in zip(each(batch.column("id")), each(batch.column("text"))):
                words = words_of(text)
                ids = np.fromiter((vocabulary.get(w, len(vocabulary)) for w in words), np.int32, len(words))
                found = []
                for row, (license_, template) in zip(has, wanted.items()):
                    for start, end, matched in find_template(
                        words, template, row[ids], share, max(between, -(-len(template) // 2))
                    ):
                        found.append((name, license_, start, end, matched, len(template)))
                rows += best_apart(found)
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_pydict({
                "id": pa.array(columns[0], id_type), "license": pa.array(columns[1], pa.string()),
                **{c: pa.array(v, pa.int64()) for c, v in zip(
                    ("start_word", "end_word", "matched_words", "template_words"), columns[2:]
                )},
            })

    found = source.mapInArrow(
        run, f"id {kind}, license string, start_word long, end_word long, matched_words long, template_words long"
    )
    return found.withColumn("coverage", F.col("matched_words") / F.col("template_words")).withColumnRenamed("id", id_col)
