"""SQL twins of the registered queries, where SQL can express them."""

from botiquin.llm.hilbert import curve_tables

# Later occurrences of three-line windows are covered, the other lines joined again.
_LINE_WINDOWS = """
WITH docs AS (
    SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), placed AS (
    SELECT doc_id, lines, unnest(range(0, greatest(len(lines) - 2, 0))) AS line FROM docs
), windows AS (
    SELECT doc_id, line,
           trim(lines[line + 1]) || chr(10) || trim(lines[line + 2]) || chr(10)
           || trim(lines[line + 3]) AS w
    FROM placed
), counted AS (
    SELECT doc_id, line, row_number() OVER (PARTITION BY w ORDER BY doc_id, line) AS nth
    FROM windows
    WHERE length(regexp_replace(w, '[ \t\r\n]', '', 'g')) >= 30
), covered AS (
    SELECT DISTINCT doc_id, line + k AS line
    FROM counted, (SELECT unnest([0, 1, 2]) AS k)
    WHERE nth > 1
), kept AS (
    SELECT d.doc_id, list(d.line_text ORDER BY d.line) AS lines, count(*) AS n_kept
    FROM (
        SELECT doc_id, unnest(lines) AS line_text, unnest(range(0, len(lines))) AS line FROM docs
    ) d
    LEFT JOIN covered c ON c.doc_id = d.doc_id AND c.line = d.line
    WHERE c.line IS NULL
    GROUP BY d.doc_id
)
SELECT d.doc_id, coalesce(len(d.lines), 0)::BIGINT AS n_lines,
       (coalesce(len(d.lines), 0) - coalesce(k.n_kept, 0))::BIGINT AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL
            ELSE sha256(coalesce(array_to_string(k.lines, chr(10)), '')) END AS text_sha256
FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# Windows of ten words, or of a whole shorter item, wherever they occur in a document.
_DECONTAMINATION = f"""
WITH docs AS (
    SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents
), items AS (
    SELECT item_id, w, least(10, len(w)) AS size
    FROM (SELECT item_id, coalesce({_WORDS}, []) AS w FROM benchmark)
    WHERE len(w) > 0
), item_windows AS (
    SELECT DISTINCT item_id, size, array_to_string(w[k : k + size - 1], ' ') AS win
    FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS k FROM items)
), doc_windows AS (
    SELECT doc_id, size, k, array_to_string(w[k : k + size - 1], ' ') AS win
    FROM (
        SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k
        FROM docs, (SELECT DISTINCT size FROM items) WHERE len(w) >= size
    )
), hits AS (
    SELECT doc_id, k, size, item_id FROM doc_windows JOIN item_windows USING (size, win)
), words_hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(k, k + size)) AS place FROM hits) GROUP BY doc_id
), items_hit AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
       coalesce(i.n_items, 0)::BIGINT AS n_items, sha256(coalesce(i.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words_hit h USING (doc_id) LEFT JOIN items_hit i USING (doc_id)
"""


def _crc_table() -> list[int]:
    """The table of the CRC with the reversed polynomial 0xEDB88320."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


def _hilbert_steps(bits: int, dims: int) -> str:
    """One step per bit from the highest: the cell's octant gives digit and next state."""
    digits, following = curve_tables(dims)
    steps = [f"step_{bits} AS (SELECT *, 0 AS state, 0::BIGINT AS curve FROM cells)"]
    for bit in range(bits - 1, -1, -1):
        octant = " + ".join(f"((c{d} >> {bit}) & 1) * {1 << d}" for d in range(dims))
        steps.append(
            f"step_{bit} AS (SELECT * EXCLUDE (state, curve), "
            f"({following})[state * {1 << dims} + {octant} + 1] AS state, "
            f"curve * {1 << dims} + ({digits})[state * {1 << dims} + {octant} + 1] AS curve "
            f"FROM step_{bit + 1})"
        )
    return ",\n".join(steps)


# Rows in the order of the curve through source, language and size level, cut into 24 shards.
_HILBERT = f"""
WITH base AS (
    SELECT doc_id, source AS v0, lang AS v1,
           CASE WHEN n_chars < 8 THEN n_chars
                ELSE length(bin(n_chars)) * 8 + ((n_chars >> (length(bin(n_chars)) - 4)) & 7)
           END AS v2,
           (strlen(coalesce(text, '')) + 8)::BIGINT AS size,
           xor(list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(
                   regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                   lambda x: ('0x' || x)::BIGINT)),
               lambda c, b: xor(c >> 8, ({_crc_table()}::BIGINT[])[(xor(c, b) & 255) + 1])
           ), 4294967295) AS text_crc32
    FROM documents
), {", ".join(f"""cells_{d} AS (
    SELECT v{d}, (coalesce(sum(n) OVER (ORDER BY v{d} NULLS FIRST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 256
           // sum(n) OVER ())::INTEGER AS c{d}
    FROM (SELECT v{d}, count(*) AS n FROM base GROUP BY v{d})
)""" for d in range(3))}, cells AS (
    SELECT b.*, c0, c1, c2 FROM base b
    JOIN cells_0 x ON b.v0 IS NOT DISTINCT FROM x.v0
    JOIN cells_1 y ON b.v1 IS NOT DISTINCT FROM y.v1
    JOIN cells_2 z ON b.v2 IS NOT DISTINCT FROM z.v2
), {_hilbert_steps(8, 3)}, ranked AS (
    SELECT *, row_number() OVER (ORDER BY curve, doc_id, text_crc32, size) - 1 AS rank,
           count(*) OVER () AS total
    FROM step_0
), cut AS (SELECT *, (rank * 24 // total)::INTEGER AS shard FROM ranked)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard,
       (rank - (shard::BIGINT * total + 23) // 24)::BIGINT AS slot,
       NULL::INTEGER AS grown_shard, curve
FROM cut
"""

# Every window of thirteen words with the smallest document it starts in.
_REPEATS = r"""
WITH docs AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), windows AS (
    SELECT doc_id, k, array_to_string(w[k : k + 12], ' ') AS win
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM docs)
), later AS (
    SELECT doc_id, k FROM (
        SELECT doc_id, k, min(doc_id) OVER (PARTITION BY win) AS first_id FROM windows
    ) WHERE first_id < doc_id
), covered AS (
    SELECT doc_id, list(DISTINCT place) AS places
    FROM (SELECT doc_id, unnest(range(k, k + 13)) AS place FROM later) GROUP BY doc_id
), words AS (
    SELECT d.doc_id, len(w) AS n_words, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place
    FROM docs d
), kept AS (
    SELECT x.doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS kept
    FROM words x
    LEFT JOIN (SELECT doc_id, unnest(places) AS place FROM covered) c USING (doc_id, place)
    WHERE c.place IS NULL GROUP BY x.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM docs d LEFT JOIN kept USING (doc_id)
"""

# Shares of all kept terms in all groups, then squared differences of pairs and from the language.
_DIVERGENCES = r"""
WITH docs AS (
    SELECT row_number() OVER () AS nr, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), found AS (
    SELECT nr, lang, source, term, count(*) AS n
    FROM (SELECT nr, lang, source, unnest(terms) AS term FROM docs) GROUP BY ALL
), kept AS (
    SELECT lang, term, sum(n)::BIGINT AS n FROM found GROUP BY lang, term HAVING count(*) >= 10
), langs AS (
    SELECT lang, count(*) AS v, sum(n)::BIGINT AS total FROM kept GROUP BY lang
), counted AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::BIGINT AS n, k.n AS n_lang
    FROM groups g JOIN kept k USING (lang)
    LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM found GROUP BY ALL) c
      ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shared AS (
    SELECT c.lang, source, term, n,
           1 + 1000000000 * (n + 2) // (sum(n) OVER (PARTITION BY c.lang, source) + 2 * v)::BIGINT AS p,
           1 + 1000000000 * (n_lang + 2) // (total + 2 * v) AS q
    FROM counted c JOIN langs USING (lang)
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shared a JOIN shared b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
), rows AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shared WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""



def _book_rounds(rounds: int) -> str:
    """Per round all parts with their nearest entry, then the floors of the entries' means."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""near_{k} AS MATERIALIZED (
    SELECT nr, p.part, min((list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, b.x)
                            + list_inner_product(b.x, b.x), entry)) AS best
    FROM parts p JOIN book_{k} b ON p.part = b.part GROUP BY nr, p.part
)""")
        if k == rounds:
            break
        steps.append(f"""book_{k + 1} AS MATERIALIZED (
    SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM book_{k} b LEFT JOIN (
        SELECT part, entry, list(floor(total / n) ORDER BY place) AS x FROM (
            SELECT part, entry, place, sum(value) AS total, count(*) AS n FROM (
                SELECT p.part, n.best[2] AS entry, unnest(p.x) AS value,
                       unnest(range(len(p.x))) AS place
                FROM parts p JOIN near_{k} n ON p.nr = n.nr AND p.part = n.part
            ) GROUP BY ALL
        ) GROUP BY part, entry
    ) m ON m.part = b.part AND m.entry = b.entry
)""")
    return ",\n".join(steps)


# All parts against all entries in every round; doubles hold these whole numbers exactly.
_BALL_CODES = f"""
WITH kept AS (
    SELECT row_number() OVER (ORDER BY vec_id, v) AS nr, * FROM (
        SELECT vec_id, label, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0
    )
), parts AS MATERIALIZED (
    SELECT nr, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] AS x
    FROM kept, (SELECT unnest([0, 1, 2, 3]) AS part)
), book_0 AS (SELECT part, nr - 1 AS entry, x FROM parts WHERE nr <= 256),
{_book_rounds(4)}, digest AS (
    SELECT sha256(string_agg(value::BIGINT::VARCHAR, ',' ORDER BY part, entry, place)) AS hex FROM (
        SELECT part, entry, unnest(x) AS value, unnest(range(len(x))) AS place FROM book_4
    )
), coded AS (
    SELECT nr, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error
    FROM near_4 GROUP BY nr
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       hex AS codebooks_sha256
FROM kept JOIN coded USING (nr), digest
"""

ORACLE: dict[str, str] = {
    "op4_benchmark_decontamination": _DECONTAMINATION,
    "op8_hilbert_sharding": _HILBERT,
    "op10_line_windows": _LINE_WINDOWS,
    "op11_relative_lz": _REPEATS,
    "op12_ball_codes": _BALL_CODES,
    "op13_source_stripes": _DIVERGENCES,
}
