"""DuckDB SQL for the operators whose whole result SQL can express."""

from __future__ import annotations

from . import chat, importance, merkle

# --- CRC-32 of a list of bytes; the table follows from its polynomial ---------------------------------
_CRC_TABLE = """(SELECT list(list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda r, z: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END) ORDER BY b) FROM range(256) t(b))"""


def _crc(text: str) -> str:
    """Of the UTF-8 bytes of ``text``, with the table as column ``crc``."""
    pairs = f"regexp_extract_all(hex(encode({text})), '..')"
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform({pairs},
        lambda h: CAST(16 * (instr('0123456789ABCDEF', h[1]) - 1) + instr('0123456789ABCDEF', h[2]) - 1 AS BIGINT))),
        lambda r, v: xor(r >> 8, crc[(xor(r, v) & 255) + 1])))"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


_A = merkle.ARITY
assert _A == 2, "the sibling below is that of a binary tree"
MERKLE = f"""
    WITH RECURSIVE t AS (SELECT {_CRC_TABLE} AS crc),
    l AS (SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
                 CASE WHEN {_crc('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_leaf('(CAST(n_chars AS HUGEINT) + 1)')}
                      ELSE {_leaf('n_chars')} END AS tampered
          FROM documents, t),
    r AS (SELECT *, coalesce('=' || lang, '') AS grp,
                 row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
                 count(*) OVER (PARTITION BY lang) AS n FROM l),
    tree AS (SELECT grp, 0 AS lvl, rank AS idx, n, leaf AS digest FROM r
             UNION ALL
             SELECT grp, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM tree
             WHERE n > 1 GROUP BY grp, lvl, idx // 2, n),
    s AS (SELECT grp, lvl AS height, digest AS subroot, row_number() OVER (ORDER BY grp) - 1 AS rank, count(*) OVER () AS n
          FROM tree WHERE n = 1),
    top AS (SELECT 0 AS lvl, rank AS idx, n, subroot AS digest FROM s
            UNION ALL
            SELECT lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM top
            WHERE n > 1 GROUP BY lvl, idx // 2, n),
    root AS (SELECT lvl AS height, digest AS root FROM top WHERE n = 1),
    low AS (SELECT r.grp, r.rank, list(CASE WHEN b.digest IS NULL THEN '-' WHEN b.idx % 2 = 0 THEN 'L' || b.digest ELSE 'R' || b.digest END
                                       ORDER BY x.lvl) AS steps
            FROM r JOIN s USING (grp), range(64) x(lvl) LEFT JOIN tree b
              ON b.grp = r.grp AND b.lvl = x.lvl AND b.idx = xor(r.rank >> x.lvl, 1)
            WHERE x.lvl < s.height GROUP BY r.grp, r.rank),
    high AS (SELECT s.grp, list(CASE WHEN b.digest IS NULL THEN '-' WHEN b.idx % 2 = 0 THEN 'L' || b.digest ELSE 'R' || b.digest END
                                ORDER BY x.lvl) AS steps
             FROM s, root, range(64) x(lvl) LEFT JOIN top b ON b.lvl = x.lvl AND b.idx = xor(s.rank >> x.lvl, 1)
             WHERE x.lvl < root.height GROUP BY s.grp),
    p AS (SELECT r.doc_id, r.leaf, s.subroot, root.root, r.tampered,
                 list_concat(coalesce(low.steps, []), coalesce(high.steps, [])) AS steps
          FROM r JOIN s USING (grp) CROSS JOIN root LEFT JOIN low ON low.grp = r.grp AND low.rank = r.rank LEFT JOIN high ON high.grp = r.grp),
    f AS (SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda x: x[2:]), '')) AS proof_sha256,
                 list_reduce(list_prepend(tampered, steps), lambda d, x: CASE x[1] WHEN 'L' THEN sha256(x[2:] || d)
                   WHEN 'R' THEN sha256(d || x[2:]) ELSE sha256(d) END) AS folded_root FROM p)
    SELECT *, folded_root = root AS verified FROM f"""

_B = importance.BUCKETS
_UPPER = "".join(map(chr, range(65, 91)))


def _runs(table: str, key: str) -> str:
    """``key, words`` (of each row of ``table``) and its features."""
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""(SELECT {key}, w, list_concat(w, list_transform(range(len(w) - 1), lambda i: w[i + 1] || ' ' || w[i + 2]),
        list_transform(range(len(w) - 2), lambda i: w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) AS runs
        FROM (SELECT {key}, {words} AS w FROM {table}))"""


RESAMPLE = f"""
    WITH t AS (SELECT {_CRC_TABLE} AS crc),
    d AS (SELECT row_number() OVER () AS row, * FROM {_runs('documents', 'doc_id')}),
    f AS (SELECT row, unnest(runs) AS run FROM d),
    g AS (SELECT unnest(runs) AS run FROM {_runs('benchmark', 'item_id')}),
    c AS (SELECT run, {_crc('run')} % {_B} AS bucket FROM (SELECT run FROM f UNION SELECT run FROM g), t),
    s AS (SELECT bucket, count(*) AS s FROM f JOIN c USING (run) GROUP BY bucket),
    b AS (SELECT bucket, count(*) AS t FROM g JOIN c USING (run) GROUP BY bucket),
    n AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS many, (SELECT coalesce(sum(t), 0) FROM b) AS few),
    gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (many + {_B})::DOUBLE
               / ((coalesce(s, 0) + 1)::DOUBLE * (few + {_B})::DOUBLE))) AS BIGINT) AS gain
             FROM s FULL JOIN b USING (bucket), n),
    w AS (SELECT row, CAST(sum(gain) AS BIGINT) AS weight FROM f JOIN c USING (run) JOIN gain USING (bucket) GROUP BY row),
    h AS (SELECT d.row, doc_id, CAST(len(runs) AS BIGINT) AS n_features, len(d.w) AS n_words, coalesce(weight, 0) AS weight,
            coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null'))[1:8]
              AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
          FROM d LEFT JOIN w USING (row)),
    o AS (SELECT *, row_number() OVER (PARTITION BY n_words >= {importance.MIN_WORDS} ORDER BY score DESC, doc_id NULLS LAST) AS place,
            count(*) OVER (PARTITION BY n_words >= {importance.MIN_WORDS}) AS of FROM h)
    SELECT doc_id, n_features, weight, score,
           CASE WHEN n_words >= {importance.MIN_WORDS} AND place <= 5 * of // 100 THEN place END AS rank FROM o"""

_WORD = r"[^\x20\x09-\x0D]+"
QUALITY = rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT r, unnest(x) AS w, generate_subscripts(x, 1) AS i
          FROM (SELECT r, regexp_extract_all(t, '{_WORD}') AS x FROM d)),
    three AS (SELECT r, i, w || ' ' || lead(w, 1) OVER p || ' ' || lead(w, 2) OVER p AS g FROM w
              WINDOW p AS (PARTITION BY r ORDER BY i)),
    met AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM three WHERE g IS NOT NULL),
    rep AS (SELECT r, count(DISTINCT i + k) AS n FROM met, range(3) q(k) WHERE met.n > 1 GROUP BY r),
    f AS (SELECT r, count(*) AS n, sum(length(w)) AS chars, count_if(regexp_matches(w, '[\p{{L}}\p{{Nl}}\p{{No}}]')) AS lettered,
                 count_if(length(w) > 1 AND w = upper(w) AND w <> lower(w)) AS shouted FROM w GROUP BY r),
    l AS (SELECT r, count(*) AS n, count(*) - count(DISTINCT x) AS dup
          FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '{_WORD}') GROUP BY r),
    c AS (SELECT doc_id, coalesce(f.n, 0) AS n_words, CAST(coalesce(f.chars, 0) AS BIGINT) AS word_chars,
                 length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.dup, 0) AS n_dup_lines,
                 coalesce(rep.n, 0) AS n_repeat_words, coalesce(lettered, 0) AS lettered, coalesce(shouted, 0) AS shouted,
                 coalesce(l.n, 0) AS n_lines
          FROM d LEFT JOIN f USING (r) LEFT JOIN l USING (r) LEFT JOIN rep USING (r)),
    b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND 4 * n_symbols <= n_words AND word_chars BETWEEN 2 * n_words AND 20 * n_words
           AND 10 * lettered >= 6 * n_words AND 2 * shouted <= n_words AND 2 * n_dup_lines <= n_lines AS kept
    FROM b"""


def _escaped_length(value: str) -> str:
    """Characters of an escaped text: each of the escaped ones becomes two."""
    return f"2 * length({value}) - length(regexp_replace({value}, '[{_ESCAPED}]', '', 'g'))"


_ESCAPED = "".join("\\" + raw for raw, _ in chat.ESCAPES)
_FIXED = len(chat.TURN_OPEN + chat.TURN_CLOSE + chat.TURN_END)
CHAT = f"""
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
    s AS (SELECT *, row_number() OVER p AS n, role = '{chat.TRAINABLE}' AS trained,
                 {_FIXED} + {_escaped_length('role')} + {_escaped_length('text')} AS chars,
                 count(*) OVER (PARTITION BY conv_id) AS turns
          FROM t WINDOW p AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
    e AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY n) AS upto FROM s)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (trained), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (trained), '')) AS loss_sha256,
           CAST(sum(upto) FILTER (trained OR n = turns) AS BIGINT) AS formatted_chars
    FROM e GROUP BY conv_id"""

ORACLE = {"op2_quality": QUALITY, "op4_chat": CHAT, "op11_merkle": MERKLE, "op12_resample": RESAMPLE}
