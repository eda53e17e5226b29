"""The same results in DuckDB SQL, for the queries that SQL can express."""

from __future__ import annotations

from lakemart.llm.licenses import COPYRIGHT_LINE, EQUIVALENT_WORDS
from lakemart.llm.line_dedup import Winnow
from lakemart.llm.mixing import Mix

# fixed values: the parts of the BSD licences
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""

# fixed values: notices, and public licence texts that are short
LICENSES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "MIT notice": "Released under the MIT License.",
    "MIT": """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
""",
    "BSD-2-Clause": _BSD_HEAD + _BSD_TAIL,
    "BSD-3-Clause": _BSD_HEAD + _BSD_THIRD + _BSD_TAIL,
    "Zlib": """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.
""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.

In jurisdictions that recognize copyright laws, the author or authors
of this software dedicate any and all copyright interest in the
software to the public domain. We make this dedication for the benefit
of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of
relinquishment in perpetuity of all present and future rights to this
software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR
OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org/>
""",
}


# fixed values: digests of the canonical forms of long public licence texts
LICENSE_DIGESTS = {
    "Apache-2.0": "14de5e59ca2d4318ac52f7c036d0b2158e82250410272372c9a552b6ace7eb5f",
    "CC0-1.0": "a1c5451395262a9c57097cf8ed1be6259bce24f74691c20b350916c920658336",
    "GPL-2.0": "8d21bb41a089644760821daf2e93230b7469575997ef211723852a31ec1d896b",
    "GPL-3.0": "93b88dcd0f8b8b73eeda341cab98f47be9a902945ee24105ac84e99fd7596885",
    "LGPL-2.1": "5ee4697aeb2e12549e99ed427790096d7f650d8fc8503439d917ae375be84486",
    "LGPL-3.0": "9da940a5cdd0ef8c6da67bf24cbe851115f32bfcb87aa56b7dec93a85f943e6d",
    "MPL-2.0": "71146a0d6e9425b18dd5d6a1b5141eab309c03ea4fae946eadfb5d069de504eb",
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _bits60(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def sharding(shards: list[str], slots: int) -> str:
    n = len(shards)
    names = ", ".join(f"({i}, {_quoted(s)})" for i, s in enumerate(shards))
    return f"""
WITH RECURSIVE names(i, name) AS (VALUES {names}),
orders AS (SELECT i, {_bits60("name || '/start'")} % {slots} AS pos,
                  {_bits60("name || '/step'")} % {slots - 1} + 1 AS step FROM names),
preferences AS (SELECT i, list((pos + j * step) % {slots} ORDER BY j) AS wish
                FROM orders, range({slots}) AS r(j) GROUP BY i),
fill(turn, owner) AS (
    SELECT 0, list_transform(range({slots}), lambda x: -1)
    UNION ALL
    SELECT turn + 1, owner[:s] || [turn % {n}] || owner[s + 2:]
    FROM (SELECT turn, owner, list_filter(wish, lambda x: owner[x + 1] = -1)[1] AS s
          FROM fill JOIN preferences ON i = turn % {n} WHERE turn < {slots})),
done AS (SELECT owner FROM fill WHERE turn = {slots}),
slot_owner AS (SELECT unnest(range({slots})) AS slot, unnest(owner) AS i FROM done),
placed AS (SELECT doc_id, source, {_bits60("coalesce(CAST(doc_id AS VARCHAR), '')")} % {slots} AS slot FROM documents)
SELECT doc_id, source, placed.slot, name AS shard
FROM placed JOIN slot_owner USING (slot) JOIN names USING (i)
"""


def license_scan() -> str:
    known = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in LICENSES.items())
    long = ", ".join(f"({_quoted(v)}, {_quoted(k)})" for k, v in LICENSE_DIGESTS.items())
    words = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in EQUIVALENT_WORDS.items())
    return f"""
WITH spelling(w, s) AS (VALUES {words}),
respell AS (SELECT map(list(w ORDER BY w), list(s ORDER BY w)) AS m FROM spelling),
known(name, text) AS (VALUES {known}),
texts AS (SELECT 'd' AS kind, doc_id, CAST(NULL AS VARCHAR) AS name, text FROM documents
          UNION ALL SELECT 'k', NULL, name, text FROM known),
split AS (SELECT kind, doc_id, name, string_split(lower(coalesce(text, '')), chr(10)) AS l FROM texts),
canonical AS (
    SELECT kind, doc_id, name, list_filter(list_transform(l, lambda x: CASE
        WHEN regexp_matches(x, {_quoted(COPYRIGHT_LINE)}) THEN ''
        ELSE array_to_string(list_transform(string_split(trim(regexp_replace(x, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' '),
             lambda w: coalesce(m[w], w)), '') END), lambda x: x <> '') AS lines
    FROM split, respell),
digests AS (SELECT kind, doc_id, name, sha256(coalesce(array_to_string(lines, ''), '')) AS digest, lines FROM canonical),
long(digest, name) AS (VALUES {long}),
names AS (SELECT digest, min(name) AS name FROM (SELECT digest, name FROM digests WHERE kind = 'k' UNION ALL SELECT digest, name FROM long)
          GROUP BY digest),
by_line AS (SELECT DISTINCT doc_id, sha256(line) AS digest
            FROM (SELECT doc_id, unnest(lines) AS line FROM digests WHERE kind = 'd')),
noticed AS (SELECT doc_id, string_agg(name, ',' ORDER BY name) AS notices FROM by_line JOIN names USING (digest) GROUP BY doc_id)
SELECT d.doc_id, d.digest, names.name AS license, coalesce(notices, '') AS notices
FROM digests d LEFT JOIN names USING (digest) LEFT JOIN noticed ON noticed.doc_id = d.doc_id
WHERE d.kind = 'd'
"""


def mixing(p: Mix) -> str:
    def weight(level: str, column: str) -> str:
        given = " ".join(f"WHEN {_quoted(k)} THEN {w}" for k, w in p.weights.get(level, {}).items())
        return f"CASE {column} {given} ELSE 1 END" if given else "1"

    def share(depth: int) -> str:
        """Even share by weight with caps: the level above is alloc{depth - 1}."""
        keys = ["domain", "lang", "source"][:depth + 1]
        parent, child = keys[:-1], keys[-1]
        by = f"PARTITION BY {', '.join(parent)}" if parent else ""
        above = f"JOIN alloc{depth - 1} USING ({', '.join(parent)})" if parent else "CROSS JOIN budget"
        return f"""
node{depth} AS (SELECT {', '.join(keys)}, cap, w, given FROM (
    SELECT {', '.join(keys)}, sum(tokens)::HUGEINT * {p.max_epochs} AS cap, ({weight(p.levels[depth], child)})::HUGEINT AS w
    FROM leaves GROUP BY ALL) {above}),
ranked{depth} AS (SELECT *,
    coalesce(sum(cap) OVER (s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower_caps,
    sum(w) OVER (s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS higher_weights
    FROM node{depth} WINDOW s AS ({by} ORDER BY cap::DOUBLE / nullif(w, 0)::DOUBLE NULLS LAST, {child})),
filled{depth} AS (SELECT *, cap * higher_weights <= (given - lower_caps) * w AS is_full FROM ranked{depth}),
alloc{depth} AS (SELECT {', '.join(keys)}, (CASE WHEN is_full THEN cap ELSE coalesce(
        (given - coalesce(sum(cap) FILTER (is_full) OVER g, 0))::HUGEINT * w
        // nullif((sum(w) FILTER (NOT is_full) OVER g)::HUGEINT, 0), 0) END)::HUGEINT AS given
    FROM filled{depth} WINDOW g AS ({by}))"""

    total = f"{p.budget}::HUGEINT" if p.budget is not None else f"sum(tokens)::HUGEINT * {p.percent} // 100"
    return f"""
WITH rows_ AS (
    SELECT doc_id, lang AS lang0, source AS source0, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
           'dom' || CAST('0x' || substr(md5(coalesce(source, '')), 1, 4) AS BIGINT) % 4 AS domain,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens
    FROM documents),
leaves AS (SELECT domain, lang, source, sum(tokens) AS tokens FROM rows_ GROUP BY ALL),
budget AS (SELECT {total} AS given FROM leaves),{share(0)},{share(1)},{share(2)},
plan AS (SELECT domain, lang, source, (given // tokens)::BIGINT AS epochs, (given % tokens)::BIGINT AS rest
         FROM leaves JOIN alloc2 USING (domain, lang, source) WHERE given > 0 AND tokens > 0),
ordered AS (SELECT *, {_bits60(f"'{p.seed}:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')")} AS k
            FROM rows_ JOIN plan USING (domain, lang, source)),
summed AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY k, CAST(doc_id AS VARCHAR)) AS upto FROM ordered)
SELECT doc_id, domain, lang0 AS lang, source0 AS source, tokens::BIGINT AS tokens,
       epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS copies
FROM summed WHERE epochs > 0 OR (rest > 0 AND upto <= rest)
"""


def line_dedup(p: Winnow) -> str:
    return f"""
WITH split AS (SELECT doc_id, md5(coalesce(text, '')) AS dig, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
all_lines AS (SELECT doc_id, dig, generate_subscripts(l, 1) - 1 AS ln, unnest(l) AS line FROM split),
counted AS (SELECT doc_id, dig, ln, md5(line) AS m, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n FROM all_lines),
worded AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ln) - 1 AS i,
           sum(n) OVER (PARTITION BY doc_id ORDER BY ln) - n AS fw FROM counted WHERE n > 0),
grams AS (SELECT *, CASE WHEN sum(n) OVER g >= {p.gram_words} THEN md5(array_to_string(list(m) OVER g, chr(10))) END AS gram,
                 max(i) OVER g AS gram_end,
                 CASE WHEN sum(n) OVER w >= {p.window_words} THEN max(i) OVER w END AS window_end
          FROM worded WINDOW
          g AS (PARTITION BY doc_id ORDER BY fw RANGE BETWEEN CURRENT ROW AND {p.gram_words - 1} FOLLOWING),
          w AS (PARTITION BY doc_id ORDER BY fw RANGE BETWEEN CURRENT ROW AND {p.window_words - 1} FOLLOWING)),
inside AS (SELECT a.doc_id, a.dig, a.i AS start_i, b.i, b.gram AS g,
                  row_number() OVER (PARTITION BY a.doc_id, a.i ORDER BY b.gram, b.i DESC) AS turn
           FROM grams a JOIN grams b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.gram_end <= a.window_end
           WHERE b.gram IS NOT NULL),
prints AS (SELECT DISTINCT doc_id, dig, i, g FROM inside WHERE turn = 1),
firsts AS (SELECT g, doc_id AS fdoc, i AS fi FROM
           (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, dig, i) AS turn FROM prints) WHERE turn = 1),
matches AS (SELECT doc_id, i, fdoc, i - fi AS shift FROM prints JOIN firsts USING (g) WHERE NOT (doc_id = fdoc AND i = fi)),
diagonals AS (SELECT DISTINCT doc_id, fdoc, shift FROM matches),
equal_lines AS (SELECT d.doc_id, d.fdoc, d.shift, a.i, a.ln FROM diagonals d
                JOIN worded a ON a.doc_id = d.doc_id
                JOIN worded b ON b.doc_id = d.fdoc AND b.i = a.i - d.shift AND b.m = a.m),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, fdoc, shift ORDER BY i) AS island FROM equal_lines),
hit AS (SELECT DISTINCT doc_id, fdoc, shift, island FROM islands JOIN matches USING (doc_id, fdoc, shift, i)),
gone AS (SELECT DISTINCT doc_id, ln FROM islands JOIN hit USING (doc_id, fdoc, shift, island)),
kept AS (SELECT doc_id, count(g.ln) AS n_removed, string_agg(line, chr(10) ORDER BY ln) FILTER (g.ln IS NULL) AS text
         FROM all_lines a LEFT JOIN gone g USING (doc_id, ln) GROUP BY doc_id)
SELECT doc_id, n_removed::INTEGER AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN md5(coalesce(k.text, '')) END AS text_md5
FROM documents d JOIN kept k USING (doc_id)
"""
