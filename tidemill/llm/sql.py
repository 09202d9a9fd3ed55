"""What some of the queries give, in the SQL of another engine."""

from __future__ import annotations

import math

from tidemill.llm import chat
from tidemill.llm.quality_rules import Policy

_BREAK = r"[\x20\x09-\x0D]+"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{_BREAK}'), lambda w: w <> '')"


def chat_format(forged_id: int, forged: str) -> str:
    order = "ORDER BY turn, role, text"
    loss = f"coalesce(string_agg(text, '' {order}) FILTER (role = '{chat.LOSS_ROLE}'), '')"
    doubled = lambda c: f"length(replace({c}, '\\', '\\\\'))"
    marks = len(chat.OPEN) + len(chat.BODY) + len(chat.CLOSE)
    return (
        "WITH messages AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations "
        f"UNION ALL VALUES ({forged_id}, 0, 'user', '{forged}'), ({forged_id}, 1, 'assistant', '{forged}')) "
        "SELECT conv_id, count(*) AS n_turns, "
        f"sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256, "
        f"length({loss}) AS loss_chars, sha256({loss}) AS loss_sha256, "
        f"CAST(sum({marks} + {doubled('role')} + {doubled('text')}) AS BIGINT) AS formatted_chars "
        "FROM messages GROUP BY conv_id"
    )


def quality_rules(policy: Policy = Policy()) -> str:
    share = lambda a, b: f"CASE WHEN {b} > 0 THEN {a} / CAST({b} AS DOUBLE) ELSE 0 END"
    measure = {
        "symbol_share": share("n_symbols", "word_chars"),
        "upper_share": share("n_upper", "word_chars"),
        "shout_share": share("n_shouts", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "long_word_mean": share("word_chars", "n_words"),
    }
    severity = ", ".join(f"({measure[k]}) / {limit}" for k, limit in policy.limits)
    without = lambda chars: f"length(translate(body, {chars}, ''))"
    p = policy.risk
    tail = (
        "CASE WHEN k >= good * {p} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i: "
        "exp(lgamma(good + 1) - lgamma(i + 1) - lgamma(good - i + 1) + i * {lp} + (good - i) * {lq}))) END"
    ).format(p=p, lp=math.log(p), lq=math.log1p(-p))
    return (
        "WITH docs AS (SELECT doc_id, lang, coalesce(text, '') AS body FROM documents), "
        f"split AS (SELECT *, {_words('body')} AS w, list_filter(string_split(body, chr(10)), "
        f"lambda x: translate(x, {_SPACE}, '') <> '') AS l FROM docs), "
        "windows AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM "
        "(SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split)), "
        "again AS (SELECT doc_id, unnest([i, i + 1, i + 2]) AS i FROM (SELECT *, count(*) OVER "
        "(PARTITION BY doc_id, a, b, c) AS n FROM windows) WHERE n > 1), "
        "repeats AS (SELECT doc_id, count(DISTINCT i) AS n_repeat_words FROM again GROUP BY doc_id), "
        "counted AS (SELECT doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, "
        f"CAST({without(_SPACE)} AS BIGINT) AS word_chars, "
        f"CAST(length(body) - {without(chr(39) + '#*$%&|<>' + chr(39))} AS BIGINT) AS n_symbols, "
        "CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, "
        "CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines, "
        r"length(body) - length(regexp_replace(body, '\p{Lu}+', '', 'g')) AS n_upper, "
        f"length(body) - {without(chr(39) + '!' + chr(39))} AS n_shouts "
        "FROM split LEFT JOIN repeats USING (doc_id)), "
        "judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, "
        f"greatest(0.0, {severity}) AS severity FROM counted), "
        "grades AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY 1), "
        "labelled AS (SELECT lang, severity, quality FROM judged JOIN grades USING (doc_id) "
        "WHERE NOT base_failed AND quality IN (0, 1)), "
        f"cutoffs AS (SELECT unnest({list(policy.cutoffs)}) AS cutoff), "
        "tries AS (SELECT lang, cutoff, count(*) FILTER (quality = 1) AS good, "
        "count(*) FILTER (quality = 0) AS bad, count(*) FILTER (quality = 1 AND severity > cutoff) AS k, "
        "count(*) FILTER (quality = 0 AND severity > cutoff) AS caught FROM labelled, cutoffs GROUP BY ALL), "
        f"tests AS (SELECT *, {tail} AS p_value, (SELECT count(*) FROM (SELECT DISTINCT lang FROM labelled)) "
        "AS strata, caught / CAST(greatest(bad, 1) AS DOUBLE) - k / CAST(good AS DOUBLE) AS gain FROM tries), "
        "chosen AS (SELECT lang, max({'gain': gain, 'cutoff': cutoff}).cutoff AS cutoff FROM tests "
        f"WHERE p_value * strata * {len(policy.cutoffs)} <= {policy.doubt} GROUP BY lang) "
        "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, "
        "NOT base_failed AND coalesce(severity <= cutoff, true) AS kept "
        "FROM judged LEFT JOIN chosen ON judged.lang IS NOT DISTINCT FROM chosen.lang"
    )


def near_duplicates(size: int, percent: int = 80) -> str:
    """All pairs that share a shingle are compared; for small tables."""
    upper = "".join(map(chr, range(65, 91)))
    parts = ", ".join(f"w[i + {j}]" for j in range(size))
    return (
        f"WITH RECURSIVE split AS (SELECT doc_id, {_words(f'translate(coalesce(text, {chr(39) * 2}), {upper!r}, {upper.lower()!r})')} "
        "AS w FROM documents), "
        f"shingles AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < {size} THEN w ELSE [{parts}] END AS s FROM "
        f"(SELECT doc_id, w, unnest(range(1, greatest(len(w) - {size - 1}, 1) + 1)) AS i FROM split WHERE len(w) > 0)), "
        "sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1), "
        "shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m FROM shingles x JOIN shingles y "
        "ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2), "
        "links AS (SELECT a, b FROM shared JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id "
        f"WHERE 100 * m >= {percent} * (p.n + q.n - m)), "
        "reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a), "
        "least AS (SELECT a AS doc_id, min(b) AS low FROM reached GROUP BY 1) "
        "SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id, "
        "doc_id <= coalesce(low, doc_id) AS kept FROM documents "
        "LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)"
    )


# The crc32 of a text's bytes, from the table of its polynomial (reversed, as a fixed value).
_CRC_TABLE = (
    "crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), "
    "lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"
)


def _crc32(text: str) -> str:
    """Needs `crc` of `_CRC_TABLE` among the relations."""
    byte = f"CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT)"
    return (
        f"xor(list_reduce(list_concat([4294967295], list_transform(range(strlen({text})), lambda i: {byte})), "
        "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
    )


def merkle_manifest() -> str:
    """Levels from the leaves up, then every leaf climbs them with its own digest."""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    leaf = lambda text: "sha256(" + " || ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), field(text)]) + ")"

    def levels(name: str, start: str) -> str:
        return (
            f"{name}(tree, level, pos, h, n) AS ({start} UNION ALL SELECT tree, level + 1, pos // 3, "
            f"sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM {name} WHERE n > 1 GROUP BY tree, level, n, pos // 3)"
        )

    def climb(name: str, start: str, nodes: str) -> str:
        before, after = (
            f"coalesce((SELECT string_agg(s.h, '' ORDER BY s.pos) FROM {nodes} s WHERE s.tree = c.tree AND s.level = c.level "
            f"AND s.pos // 3 = c.pos // 3 AND s.pos {sign} c.pos), '')"
            for sign in "<>"
        )
        return (
            f"{name} AS ({start} UNION ALL SELECT id, tree, level + 1, pos // 3, (n + 2) // 3, "
            f"sha256(b || f || a), met || b || a FROM (SELECT c.*, {before} AS b, {after} AS a FROM {name} c WHERE n > 1))"
        )

    begun = "SELECT id, tree, 0 AS level, pos, n, found AS f, '' AS met FROM leaves"
    up = (
        "SELECT id, '' AS tree, 0 AS level, u.pos, u.n, f, met FROM climbed c JOIN upper_nodes u "
        "ON u.level = 0 AND u.h = c.h AND u.pos = c.k"
    )
    return (
        f"WITH RECURSIVE {_CRC_TABLE}, marked AS (SELECT *, CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 2 = 0 "
        "THEN replace(text, chr(10), '') ELSE text END AS cut FROM documents, crc), "
        f"hashed AS (SELECT doc_id, coalesce('=' || source, '') AS tree, {leaf('text')} AS h, {leaf('cut')} AS found FROM marked), "
        "leaves AS (SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, h) AS id, "
        "row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, "
        "count(*) OVER (PARTITION BY tree) AS n FROM hashed), "
        + levels("nodes", "SELECT tree, 0, pos, h, n FROM leaves")
        + ", tops AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS k, count(*) OVER () AS n FROM nodes WHERE n = 1), "
        + levels("upper_nodes", "SELECT '', 0, k, h, n FROM tops")
        + ", "
        + climb("climbing", begun, "nodes")
        + ", climbed AS (SELECT c.*, tops.h, tops.k FROM climbing c JOIN tops USING (tree) WHERE c.n = 1), "
        + climb("rising", up, "upper_nodes")
        + ", root AS (SELECT h AS root FROM upper_nodes WHERE n = 1) "
        "SELECT doc_id, leaves.h AS leaf, tops.h AS subroot, root, sha256(r.met) AS proof_sha256, r.f AS folded_root, "
        "r.f = root AS verified FROM leaves JOIN tops USING (tree) JOIN rising r ON r.id = leaves.id AND r.n = 1, root"
    )


def spelling_groups() -> str:
    """Near words by the texts that are left when a letter is left out."""
    upper = "".join(map(chr, range(65, 91)))
    return (
        f"WITH RECURSIVE {_CRC_TABLE}, found AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, "
        f"unnest(regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), '[a-z\u00C0-\u00FF]+')) AS run FROM documents), "
        "pairs AS (SELECT id || ':' || run AS pair, run, count(*) AS k FROM found GROUP BY ALL), "
        f"drawn AS (SELECT run, k, {_crc32('pair')} AS h FROM pairs, crc), "
        "cut AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) "
        "ELSE run END AS word, k FROM drawn), "
        "words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM cut WHERE length(word) >= 5 GROUP BY 1 HAVING sum(k) >= 3), "
        "places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words), "
        "rests AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places), "
        "near AS (SELECT a.word, b.word AS other, b.n AS m FROM rests a JOIN rests b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word "
        "UNION SELECT r.word, w.word, w.n FROM rests r JOIN words w ON r.rest = w.word "
        "UNION SELECT w.word, r.word, r.n FROM rests r JOIN words w ON r.rest = w.word), "
        "best AS (SELECT word, count(*) AS n_near, min({'m': -m, 'other': other}) AS b FROM near GROUP BY 1), "
        "formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.m >= 2 * n THEN b.other END AS form, "
        "CASE WHEN -b.m >= 2 * n THEN -b.m END AS form_n FROM words LEFT JOIN best USING (word)), "
        "led AS (SELECT word, word AS root, form AS next FROM formed UNION ALL "
        "SELECT led.word, f.word, f.form FROM led JOIN formed f ON led.next = f.word) "
        "SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, root FROM led WHERE next IS NULL) USING (word)"
    )
