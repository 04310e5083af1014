"""SQL that gives the rows of the sharding, collocation and conversation queries."""

from __future__ import annotations

CRC = r"""
        crc_table AS MATERIALIZED (
            SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, bit:
                CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS crc
        )
"""


def crc32(text):
    """CRC-32 of a text's UTF-8 bytes in SQL, with ``crc_table`` joined."""
    data = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce({data}, lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


SHARDING = f"""
        WITH {CRC}, rows AS MATERIALIZED (
            SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size, {crc32("coalesce(text, '')")} AS text_crc32,
                   ('0x' || md5(coalesce(text, ''))[:15])::BIGINT AS grp, ('0x' || md5(coalesce(doc_id::VARCHAR, ''))[:15])::BIGINT AS member
            FROM documents, crc_table
        ), placed AS (
            SELECT *, sum(size) OVER ()::BIGINT AS total, (sum(size) OVER by_key - size)::BIGINT AS before, row_number() OVER by_key AS place
            FROM rows WINDOW by_key AS (ORDER BY grp, member ROWS UNBOUNDED PRECEDING)
        ), groups AS (
            SELECT grp, min(before) AS first, max(before + size) AS last FROM placed GROUP BY grp
        ), ideal AS (
            SELECT DISTINCT j, total * j // 16 AS cut, total FROM placed, range(1, 16) shares(j)
        ), cuts AS (
            SELECT j, CASE WHEN grp IS NULL THEN cut WHEN 2 * cut <= first + last THEN first ELSE last END AS cut
            FROM ideal LEFT JOIN groups ON first < cut AND cut < last AND last - first <= 0.01 * total / 16
        ), sharded AS (
            SELECT *, (SELECT count(*) FROM cuts WHERE 2 * cut <= 2 * before + size)::INT AS shard FROM placed
        )
        SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, place - min(place) OVER (PARTITION BY shard) AS slot,
               NULL::INT AS grown_shard
        FROM sharded
"""

# an edit is (cost, audit, repaired text), the text with a newline in front of every row


CUT_OFF = "(fault = 'truncated')::BIGINT"
KEPT = "chr(10) || role || ':' || text"
NEVER = "{'cost': 1000000000, 'audit': '', 'out': ''}"


def edit(cost, letter, row, state):
    return f"{{'cost': {cost} + {state}.cost, 'audit': '{letter}' || {state}.audit, 'out': {row} || {state}.out}}"


def insert(role, state):
    return edit(2, "I", f"chr(10) || '{role}:'", state)


def of_state(state, after, written):
    """Delete, rerole or keep the row in a state; ``after`` maps initials to the states behind a kept row."""
    stays = "fault NOT IN ('blank', 'duplicate')"
    kept = " ".join(f"WHEN initial = '{k}' AND {stays} THEN {edit(CUT_OFF, 'K', KEPT, v)}" for k, v in after.items())
    role, behind = written
    again = f"chr(10) || '{role}:' || text"
    return f"""least({edit(3, "D", "''", state)},
                CASE WHEN {stays} THEN {edit("2 + " + CUT_OFF, "R", again, behind)} ELSE {NEVER} END,
                CASE {kept} ELSE {NEVER} END)"""


CONVERSATIONS = f"""
        WITH RECURSIVE {CRC}, kinds AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
            FROM conversations, crc_table
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
            FROM kinds WHERE kind <> 0
        ), ordered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM damaged
        ), rows AS MATERIALIZED (
            SELECT *, role[1] AS initial, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS earlier,
                   CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
                        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                        WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE 'none' END AS fault
            FROM ordered
        ), facts AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM rows GROUP BY conv_id
        ), best AS (
            SELECT conv_id, n AS i, {{'cost': 0::BIGINT, 'audit': '', 'out': ''}} AS s0,
                   {{'cost': 4::BIGINT, 'audit': 'II', 'out': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS s1,
                   {{'cost': 2::BIGINT, 'audit': 'I', 'out': chr(10) || 'assistant:'}} AS s2, {{'cost': 0::BIGINT, 'audit': '', 'out': ''}} AS s3
            FROM facts
            UNION ALL
            SELECT conv_id, i, least(own0, {insert("user", "user")}) AS s0, least(own1, {insert("user", "user")}) AS s1, user AS s2,
                   least(own3, {insert("user", "user")}) AS s3
            FROM (
                SELECT *, least(own2, {insert("assistant", "own3")}) AS user FROM (
                    SELECT b.conv_id, b.i - 1 AS i,
                           {of_state("s0", {"s": "s1", "u": "s2"}, ("user", "s2"))} AS own0,
                           {of_state("s1", {"u": "s2"}, ("user", "s2"))} AS own1,
                           {of_state("s2", {"a": "s3"}, ("assistant", "s3"))} AS own2,
                           {of_state("s3", {"u": "s2"}, ("user", "s2"))} AS own3
                    FROM best b JOIN rows r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i))
        )
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(s0.cost, 0) AS cost,
               coalesce(s0.audit, '') AS audit, sha256(coalesce(s0.out[2:], '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = 0
"""

COLLOCATIONS = r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM (
                SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM documents)
        ), grams AS (
            SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g
            FROM pieces, (VALUES (1), (2), (3)) sizes(k)
        ), counts AS MATERIALIZED (
            SELECT lang, k, g, count(*) AS f FROM grams GROUP BY lang, k, g
        ), totals AS (
            SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang
        ), often AS MATERIALIZED (
            SELECT lang, k, g, f, split(g, ' ') AS w FROM counts WHERE f >= 10
        ), cuts AS MATERIALIZED (
            SELECT lang, g, f AS a, 1 AS cut, w[1] AS head, array_to_string(w[2:k], ' ') AS tail FROM often WHERE k > 1
            UNION ALL
            SELECT lang, g, f, 2, array_to_string(w[1:2], ' '), w[3] FROM often WHERE k = 3
        ), best AS (
            SELECT c.lang, c.g, a, h.f AS l, t.f AS r, (1000000::HUGEINT * a * a // (h.f::HUGEINT * t.f))::BIGINT AS score
            FROM cuts c JOIN often h ON h.lang = c.lang AND h.g = c.head JOIN often t ON t.lang = c.lang AND t.g = c.tail
            QUALIFY row_number() OVER (PARTITION BY c.lang, c.g ORDER BY score, cut) = 1
        ), longer AS (
            SELECT lang, g, max(f) AS longest FROM (
                SELECT lang, array_to_string(w[1:2], ' ') AS g, f FROM often WHERE k = 3
                UNION ALL SELECT lang, array_to_string(w[2:3], ' '), f FROM often WHERE k = 3) GROUP BY lang, g
        ), ranked AS (
            SELECT lang, g AS phrase, a, l, r, n, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank
            FROM best JOIN totals USING (lang) LEFT JOIN longer USING (lang, g) WHERE 100 * coalesce(longest, 0) < 50 * a
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
