"""DuckDB SQL for the ``opN_*`` queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

#: Operator 3: slots and shards as in ``sharding.TABLE_SIZE`` and ``queries.SHARDS``.
ORACLES["op3_shard_documents"] = """
WITH RECURSIVE prefs AS (
    SELECT i, list_transform(range(2039), lambda j: CAST((o + j * s) % 2039 AS INTEGER)) AS pref
    FROM (SELECT i, ('0x' || substr(md5(printf('shard-%02d', i) || '#offset'), 1, 8))::BIGINT % 2039 AS o,
                 ('0x' || substr(md5(printf('shard-%02d', i) || '#step'), 1, 8))::BIGINT % 2038 + 1 AS s
          FROM range(16) t(i))
), claims(turn, taken) AS (
    SELECT 0, CAST([] AS INTEGER[])
    UNION ALL
    SELECT turn + 1, list_append(taken, list_filter(pref, lambda x: NOT list_contains(taken, x))[1])
    FROM claims JOIN prefs ON prefs.i = claims.turn % 16 WHERE turn < 2039
), slots AS (
    SELECT unnest(taken) AS slot, unnest(range(2039)) % 16 AS i FROM claims WHERE turn = 2039
)
SELECT doc_id, source, slot, printf('shard-%02d', i) AS shard
FROM documents JOIN slots ON slot = ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT % 2039
"""

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(text: str) -> str:
    return f"translate({text}, '{_CAPITALS}', '{_CAPITALS.lower()}')"


#: crc32 by the reflected polynomial, a byte at a time; ``tab`` holds the remainders of the 256 byte values.
_CRC_TABLE = """crc_table AS (
    SELECT list(c ORDER BY i) AS tab FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) t(i))
)"""


def _crc(text: str) -> str:
    octets = f"list_transform(range(strlen({text})), lambda k: CAST('0x' || substr(hex(encode({text})), 2 * k + 1, 2) AS BIGINT))"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])))"


#: Operator 11 by joins of words with their buckets' gains.
ORACLES["op11_resample_documents"] = f"""
WITH {_CRC_TABLE}, texts AS (
    SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), words AS (
    SELECT side, id, word, count(*) AS times
    FROM (SELECT side, id, unnest(regexp_extract_all({_lower("coalesce(text, '')")}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS word FROM texts)
    GROUP BY ALL
), placed AS (
    SELECT word, CAST({_crc("word")} % 10000 AS BIGINT) AS bucket FROM (SELECT DISTINCT word FROM words), crc_table
), counts AS (
    SELECT bucket, sum(CASE WHEN side = 0 THEN times ELSE 0 END) AS s, sum(CASE WHEN side = 1 THEN times ELSE 0 END) AS t
    FROM words JOIN placed USING (word) GROUP BY bucket
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(sum(s) OVER () + 10000 AS DOUBLE)
        / (CAST(s + 1 AS DOUBLE) * CAST(sum(t) OVER () + 10000 AS DOUBLE)))) AS BIGINT) AS gain
    FROM counts
), summed AS (
    SELECT id, sum(times) AS n, sum(times * gain) AS weight
    FROM words JOIN placed USING (word) JOIN gains USING (bucket) WHERE side = 0 GROUP BY id
), scored AS (
    SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
        CAST(coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5)
            / 4294967296::DOUBLE))) AS BIGINT) AS BIGINT) AS score
    FROM documents LEFT JOIN summed ON id = doc_id
), ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT scored.*, place AS rank FROM scored LEFT JOIN ranked ON ranked.doc_id = scored.doc_id AND place <= 10 * n // 100
"""


def _merkle_sql(group_levels: int = 5, top_levels: int = 3) -> str:
    """Operator 13 level by level: every node beside those of its run. Enough levels for 16 ** group_levels rows of a source."""
    field = lambda f: f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || {f}, '-')"
    before = " || ".join(field(f) for f in ("doc_id", "source", "lang", "n_chars"))
    picked = f"({_crc('CAST(doc_id AS VARCHAR)')}) % 5 = 0"
    parts = [_CRC_TABLE, f"""leaves AS (
        SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) AS g, sha256({before} || {field("text")}) AS leaf,
            sha256({before} || CASE WHEN {picked} THEN {field(_lower("text"))} ELSE {field("text")} END) AS changed
        FROM documents, crc_table)""",
             "a0 AS (SELECT g, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS pos, leaf AS hash, count(*) OVER (PARTITION BY g) AS n, "
             "doc_id, changed FROM leaves)"]

    def level(name: str, k: int) -> None:
        at, up = f"{name}{k}", f"{name}{k + 1}"
        parts.append(f"{up} AS (SELECT g, pos // 16 AS pos, CASE WHEN any_value(n) = 1 THEN any_value(hash) ELSE sha256(string_agg(hash, '' ORDER BY pos)) END "
                     f"AS hash, (any_value(n) + 15) // 16 AS n FROM {at} GROUP BY g, pos // 16)")
        parts.append(f"{at}s AS (SELECT x.g, x.pos, any_value(x.n) AS n, coalesce(string_agg(y.hash, '' ORDER BY y.pos) FILTER (WHERE y.pos < x.pos), '') AS l, "
                     f"coalesce(string_agg(y.hash, '' ORDER BY y.pos) FILTER (WHERE y.pos > x.pos), '') AS r "
                     f"FROM {at} x JOIN {at} y ON x.g = y.g AND x.pos // 16 = y.pos // 16 GROUP BY x.g, x.pos)")

    for k in range(group_levels):
        level("a", k)
    parts.append(f"b0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g) - 1 AS pos, hash, count(*) OVER () AS n, g AS source_rank FROM a{group_levels})")
    for k in range(top_levels):
        level("b", k)
    parts.append(f"f0 AS (SELECT a0.doc_id, a0.g, a0.pos, a0.hash AS leaf, b0.hash AS subroot, b0.pos AS place, b{top_levels}.hash AS root, a0.changed AS h, '' AS p "
                 f"FROM a0 JOIN b0 ON b0.source_rank = a0.g, b{top_levels})")
    steps = [(f"a{k}s", "g", "pos", 16**k) for k in range(group_levels)] + [(f"b{k}s", "0", "place", 16**k) for k in range(top_levels)]
    for i, (at, g, pos, size) in enumerate(steps):
        parts.append(f"f{i + 1} AS (SELECT f.* EXCLUDE (h, p), CASE WHEN s.n > 1 THEN sha256(s.l || h || s.r) ELSE h END AS h, p || s.l || s.r AS p "
                     f"FROM f{i} f JOIN {at} s ON s.g = {'f.' + g if g != '0' else '0'} AND s.pos = f.{pos} // {size})")
    return (f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, root, sha256(p) AS proof_sha256, h AS folded_root, h = root AS verified "
            f"FROM f{len(steps)}")


ORACLES["op13_merkle_manifest"] = _merkle_sql()
