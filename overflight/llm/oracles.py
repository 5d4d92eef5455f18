"""The corpus queries as SQL for DuckDB, where SQL can say them.

They state the definitions on strings and lists; hashing, signatures and
diagonals do not occur in them, except where a result column counts them.
"""

from __future__ import annotations

from overflight.llm import chat, decontam, importance, licenses, quality, substrings

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _space_words(column: str = "text") -> str:
    return rf"regexp_extract_all(coalesce({column}, ''), '[^\x20\x09-\x0D]+')"


def _alnum_words(column: str = "text") -> str:
    return rf"regexp_extract_all(translate(coalesce({column}, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _licenses() -> str:
    listed = licenses.templates()
    rows = ", ".join(
        f"({t.number}, {_text(' '.join(t.words))}, {_text(t.label)}, {t.gram}, {t.grams}, {str(t.whole).lower()})" for t in listed)
    sizes = sorted({t.gram for t in listed})
    places = " UNION ALL ".join(
        f"SELECT doc_id, {n} AS size, unnest(range(0, len(words) - {n - 1})) AS pos, words FROM w WHERE len(words) >= {n}" for n in sizes)
    return f"""
    WITH templates(template, phrase, label, size, grams, whole) AS (VALUES {rows}),
    w AS (SELECT doc_id, {_alnum_words()} AS words FROM documents),
    parts AS (SELECT *, unnest(range(0, grams)) AS q FROM templates),
    pieces AS (SELECT *, array_to_string(string_split(phrase, ' ')[q + 1:q + size], ' ') AS gram FROM parts),
    places AS ({places}),
    spots AS (SELECT doc_id, size, pos, array_to_string(words[pos + 1:pos + size], ' ') AS gram FROM places),
    met AS (SELECT DISTINCT doc_id, template, label, grams, whole, q, pos AS p, pos - q AS diagonal FROM spots JOIN pieces USING (size, gram)),
    starts AS (SELECT DISTINCT doc_id, template, diagonal AS start FROM met),
    -- all places that a span beginning at a diagonal may take, in the order of the template
    spans AS (
        SELECT doc_id, template, label, grams, whole, start, list({{'q': q, 'p': p, 'n': 0}} ORDER BY q, p) AS places
        FROM met JOIN starts USING (doc_id, template)
        WHERE diagonal BETWEEN start AND start + CASE WHEN whole THEN 0 ELSE {licenses.DRIFT} END GROUP BY ALL),
    -- the longest series that rises in template and text: each place goes on from the best one before it
    series AS (
        SELECT * EXCLUDE (places), list_max(list_transform(list_reduce(
            list_transform(places, lambda x: [x]),
            lambda known, one: list_append(known, {{'q': one[1].q, 'p': one[1].p, 'n': 1 + coalesce(list_max(list_transform(
                list_filter(known, lambda k: k.q < one[1].q AND k.p < one[1].p), lambda k: k.n)), 0)}}),
            []::STRUCT(q BIGINT, p BIGINT, n BIGINT)[]), lambda x: x.n)) / grams AS share
        FROM (SELECT * REPLACE (list_transform(places, lambda x: {{'q': x.q::BIGINT, 'p': x.p::BIGINT, 'n': 0::BIGINT}}) AS places) FROM spans
              WHERE len(list_distinct(list_transform(places, lambda x: x.q))) >= {licenses.COVERAGE} * grams)),
    held AS (
        SELECT *, start - lag(start) OVER (PARTITION BY doc_id, template ORDER BY start) <= {licenses.DRIFT} IS TRUE AS same
        FROM series WHERE share >= CASE WHEN whole THEN 1.0 ELSE {licenses.COVERAGE} END),
    found AS (
        SELECT doc_id, count(*) FILTER (whole) AS n_base, min(start) FILTER (whole) AS first_word,
            max(start) FILTER (whole) AS last_word,
            array_to_string(list_sort(list(DISTINCT label) FILTER (whole)), ',') AS base_labels,
            array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(share) AS score,
            count(*) FILTER (NOT whole AND NOT same) AS n_notices
        FROM held GROUP BY doc_id)
    SELECT w.doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
        coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score,
        coalesce(n_notices, 0) AS n_notices
    FROM w LEFT JOIN found USING (doc_id)"""


_NEAR = rf"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS words
        FROM documents),
    sets AS (
        SELECT doc_id, list_distinct(CASE
            WHEN len(words) >= 3 THEN list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])
            WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS grams FROM w),
    posted AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets),
    links AS (
        SELECT a.doc_id AS a, b.doc_id AS b FROM posted a JOIN posted b ON a.gram = b.gram AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, len(grams) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)"""


def _quality() -> str:
    last = len(next(iter(quality.RULES.values())))
    steps = ", ".join(
        "CASE " + " ".join(f"WHEN {rule.replace('_m.', 'm.')} > {cutoff!r} THEN {step}" for step, cutoff in enumerate(cutoffs, 1)) + " END"
        for rule, cutoffs in quality.RULES.items())
    risk = quality.RISK
    count = lambda chars: rf"length(regexp_replace(t, '[^{chars}]+', '', 'g'))"
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS t, {_space_words()} AS words FROM documents),
    l AS (SELECT row, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
    places AS (SELECT row, unnest(range(1, len(words) - 3)) AS i, words FROM d WHERE len(words) >= 5),
    windows AS (
        SELECT row, i, count(*) OVER (PARTITION BY row, array_to_string(words[i:i + 4], ' ')) AS times FROM places),
    repeated AS (
        SELECT row, count(DISTINCT i + k) AS n FROM windows, (SELECT unnest(range(0, 5)) AS k) WHERE times > 1 GROUP BY row),
    m AS (
        SELECT row, doc_id, lang, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
            {count("#*$%&|<>")} AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
            coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines, {count("!")} AS bangs,
            {count(chr(92) + "p{Lu}")} AS capitals, {count("0-9")} AS digits
        FROM d JOIN l USING (row) LEFT JOIN repeated USING (row)),
    q AS (
        SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
            [{steps}] AS steps, coalesce(lang, chr(0)) AS stratum FROM m),
    marks AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
    sound AS (SELECT row, stratum, steps, quality FROM q LEFT JOIN marks USING (doc_id) WHERE NOT base_failed),
    ladder AS (SELECT r, level FROM (SELECT unnest(range(1, {len(quality.RULES) + 1})) AS r), (SELECT unnest(range(1, {last + 1})) AS level)),
    rejected AS (SELECT row, stratum, quality, r, level FROM sound, ladder WHERE steps[r] <= level),
    ordered AS (
        SELECT stratum, r, level, row_number() OVER (PARTITION BY stratum ORDER BY (other + 1) / (bad + 1), r, level) AS place
        FROM (SELECT stratum, r, level, count(*) FILTER (quality IS NULL) AS other, count(*) FILTER (quality IS NOT NULL) AS bad
            FROM rejected WHERE quality IS DISTINCT FROM 1 GROUP BY ALL)),
    strata AS (SELECT stratum, count(*) AS n FROM sound WHERE quality = 1 GROUP BY stratum),
    first_place AS (
        SELECT stratum, row, min(place) AS place FROM rejected JOIN ordered USING (stratum, r, level) WHERE quality = 1 GROUP BY ALL),
    tested AS (
        SELECT stratum, place, n, (SELECT count(*) FROM first_place f WHERE f.stratum = o.stratum AND f.place <= o.place) AS k
        FROM ordered o JOIN strata USING (stratum)),
    failed AS (
        SELECT stratum, min(place) AS failed FROM tested
        WHERE k >= n * {risk} OR (SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({risk}) + (n - j) * ln(1 - {risk})))
            FROM (SELECT unnest(range(0, k + 1)) AS j)) > {quality.ERROR} / (SELECT count(*) FROM strata)
        GROUP BY stratum),
    cutoffs AS (
        SELECT stratum, r, max(level) AS cutoff FROM ordered JOIN strata USING (stratum) LEFT JOIN failed USING (stratum)
        WHERE place < failed OR failed IS NULL GROUP BY ALL),
    verdicts AS (SELECT row, min(r) AS rule FROM q JOIN cutoffs USING (stratum) WHERE steps[r] <= cutoff GROUP BY row)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(list_min(steps), 0) AS hit_level,
        NOT base_failed AND rule IS NULL AS kept, coalesce(rule, 0) AS rejected_by
    FROM q LEFT JOIN verdicts USING (row)"""


def _decontamination() -> str:
    """No seeds: texts and items are aligned wherever three words in a row are equal, which every overlap has."""
    least, short, window = decontam.LEAST_RUN, decontam.SPAN, decontam.WINDOW
    triple = lambda words, at: f"{words}[{at} + 1] || ' ' || {words}[{at} + 2] || ' ' || {words}[{at} + 3]"
    return f"""
    WITH w AS (SELECT DISTINCT doc_id, {_alnum_words()} AS words FROM documents),
    items AS (SELECT item_id, {_alnum_words()} AS item_words FROM benchmark),
    spots AS (SELECT doc_id, words, unnest(range(0, len(words) - 2)) AS p FROM w WHERE len(words) > 2),
    item_at AS (SELECT item_id, item_words, unnest(range(0, len(item_words) - 2)) AS q FROM items WHERE len(item_words) >= {short}),
    aligned AS (
        SELECT DISTINCT doc_id, item_id, words, item_words, p - q AS shift
        FROM (SELECT *, {triple("words", "p")} AS triple FROM spots)
        JOIN (SELECT *, {triple("item_words", "q")} AS triple FROM item_at) USING (triple)),
    bounded AS (
        SELECT *, least(len(item_words), {window}) AS size, greatest(0, -shift) AS low, least(len(item_words), len(words) - shift) AS high
        FROM aligned),
    placed AS (SELECT *, least(size, high - low) AS length FROM bounded),
    windows AS (SELECT *, unnest(range(low, high - length + 1)) AS a FROM placed),
    shares AS (
        SELECT doc_id, item_id, len(item_words) AS item_words, a + shift AS first, a + shift + length - 1 AS last,
            len(list_filter(range(a, a + length), lambda i: item_words[i + 1] = words[i + shift + 1])) / size AS share FROM windows),
    runs AS (
        SELECT doc_id, item_id, len(item_words) AS item_words, p AS first, p + len(item_words) - 1 AS last, 1.0::DOUBLE AS share
        FROM (SELECT doc_id, words, unnest(range(0, len(words))) AS p FROM w) x
        JOIN (SELECT * FROM items WHERE len(item_words) BETWEEN 1 AND {short - 1}) i
        ON words[p + 1:p + len(item_words)] = item_words AND (len(item_words) >= {least} OR len(words) = len(item_words)))
    SELECT doc_id, item_id, max(item_words) AS item_words, min(first) AS first_word, max(last) AS last_word, max(share)::DOUBLE AS identity
    FROM (SELECT * FROM shares WHERE share >= {decontam.IDENTITY} UNION ALL SELECT * FROM runs) GROUP BY doc_id, item_id"""


def _chat() -> str:
    escape = lambda x: f"regexp_replace({x}, {_text(chat._MARKED)}, {_text(chr(92) + '1' + chr(92) * 2 + chr(92) + '2' + chr(92) + '3')}, 'g')"
    return f"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
    shown AS (
        SELECT *, {escape("replace(replace(role, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n')")} AS shown_role,
            {escape("text")} AS shown_text FROM rows)
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (role = '{chat.LEARNED_ROLE}'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = '{chat.LEARNED_ROLE}'), '')) AS loss_sha256,
        sum({len(chat.START) + len(chat.END) + 2} + length(shown_role) + length(shown_text))::BIGINT AS formatted_chars
    FROM shown GROUP BY conv_id"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes; the table follows from the polynomial."""
    table = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    coded = f"hex(encode({text}))"
    octets = f"list_transform(range(0, length({coded}) // 2), lambda i: ('0x' || substr({coded}, 2 * i + 1, 2))::BIGINT)"
    return (f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, ({table}::BIGINT[])[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), "
            "4294967295::BIGINT)")


def _importance(percent: int = 25, least: int = 20, seed: int = 7) -> str:
    """Features as strings, each counted by bucket."""
    listed = lambda table, row: f"""SELECT {row}, unnest(list_concat(words, list_transform(
        range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS feature FROM {table}"""  # noqa: E731
    return f"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_alnum_words()} AS words FROM documents),
    b AS (SELECT item_id, {_alnum_words()} AS words FROM benchmark),
    of_docs AS ({listed("d", "row")}), of_items AS ({listed("b", "item_id")}),
    buckets AS (SELECT feature, {_crc32("feature")} % {importance.BUCKETS} AS bucket
        FROM (SELECT feature FROM of_docs UNION SELECT feature FROM of_items)),
    s AS (SELECT bucket, count(*) AS s FROM of_docs JOIN buckets USING (feature) GROUP BY bucket),
    t AS (SELECT bucket, count(*) AS t FROM of_items JOIN buckets USING (feature) GROUP BY bucket),
    gains AS (
        SELECT s.bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM s) + {importance.BUCKETS})::DOUBLE)
            / ((s + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM t), 0) + {importance.BUCKETS})::DOUBLE)))::BIGINT AS gain
        FROM s LEFT JOIN t USING (bucket)),
    weights AS (
        SELECT row, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
        FROM of_docs JOIN buckets USING (feature) JOIN gains USING (bucket) GROUP BY row),
    scored AS (
        SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(
            -1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
        FROM d LEFT JOIN weights USING (row)),
    able AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place FROM scored WHERE n_words >= {least})
    SELECT doc_id, n_words, n_features, weight, score,
        CASE WHEN place <= {percent} * (SELECT count(*) FROM able) // 100 THEN place END AS rank FROM able
    UNION ALL SELECT doc_id, n_words, n_features, weight, score, NULL FROM scored WHERE n_words < {least}"""


_SUBSTRINGS = f"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_space_words()} AS words FROM documents),
    places AS (SELECT row, unnest(range(1, len(words) - {substrings.LENGTH - 2})) AS i, words FROM d WHERE len(words) >= {substrings.LENGTH}),
    windows AS (SELECT row, i, count(*) OVER (PARTITION BY array_to_string(words[i:i + {substrings.LENGTH - 1}], ' ')) AS times FROM places),
    removed AS (
        SELECT row, list(DISTINCT i + k) AS gone FROM windows, (SELECT unnest(range(0, {substrings.LENGTH})) AS k)
        WHERE times > 1 GROUP BY row),
    left_over AS (
        SELECT row, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
    gone AS (SELECT row, unnest(gone) AS i FROM removed),
    kept AS (
        SELECT row, string_agg(word, ' ' ORDER BY i) AS text FROM left_over ANTI JOIN gone USING (row, i) GROUP BY row)
    SELECT doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
    FROM d LEFT JOIN removed USING (row) LEFT JOIN kept USING (row)"""


def _repair() -> str:
    """Row after row: the least (cost, audit) that leaves the repaired rows in each state."""
    paid = lambda state, cost, edit: f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}'}}"
    never = "{'c': 1000000000, 'a': '~'}"
    to_user = lambda cost, edit: ", ".join(paid(s, cost, edit) for s in ("s0", "s1", "s3"))
    may = lambda allowed, listed: f"CASE WHEN {allowed} THEN least({listed}) ELSE {never} END"
    more, stays = "(fault = 't')::INT", "fault <> 'd'"
    return f"""
    WITH RECURSIVE drawn AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault FROM conversations),
    hurt AS (
        SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
            CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(range(0, CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
        FROM drawn WHERE fault <> 0),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM hurt),
    judged AS (
        SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
            WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' END AS found,
            substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
        FROM numbered),
    symbols AS (
        SELECT conv_id, i, role, text, initial, CASE WHEN found IN ('blank', 'duplicate') THEN 'd' WHEN found = 'truncated' THEN 't' ELSE '-' END AS fault
        FROM judged),
    parse(conv_id, i, s0, s1, s2, s3) AS (
        SELECT DISTINCT conv_id, 0::BIGINT, {{'c': 0, 'a': ''}}, {never}, {{'c': 2, 'a': 'I'}}, {{'c': 4, 'a': 'II'}} FROM symbols
        UNION ALL
        SELECT conv_id, i, t0, t1, u2, least(t3, {paid("u2", 2, "I")})
        FROM (
            SELECT *, least(t2, {paid("t0", 2, "I")}, {paid("t1", 2, "I")}, {paid("t3", 2, "I")}) AS u2
            FROM (
                SELECT x.conv_id, x.i, {paid("s0", 3, "D")} AS t0,
                    least({paid("s1", 3, "D")}, {may(f"{stays} AND initial = 's'", paid("s0", more, "K"))}) AS t1,
                    least({paid("s2", 3, "D")}, {may(f"{stays} AND initial = 'u'", to_user(more, "K"))},
                        {may(stays, to_user(f"2 + {more}", "R"))}) AS t2,
                    least({paid("s3", 3, "D")}, {may(f"{stays} AND initial = 'a'", paid("s2", more, "K"))},
                        {may(stays, paid("s2", f"2 + {more}", "R"))}) AS t3
                FROM parse p JOIN symbols x ON x.conv_id IS NOT DISTINCT FROM p.conv_id AND x.i = p.i + 1))),
    best AS (SELECT conv_id, least(s0, s3) AS best FROM parse p WHERE i = (SELECT max(i) FROM symbols s WHERE s.conv_id IS NOT DISTINCT FROM p.conv_id)),
    letters AS (
        SELECT conv_id, unnest(string_split(best.a, '')) AS edit, unnest(range(1, length(best.a) + 1)) AS k FROM best),
    placed AS (
        SELECT *, sum(CASE WHEN edit <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY k) AS i,
            sum(CASE WHEN edit <> 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY k) AS nth FROM letters),
    edited AS (
        SELECT p.conv_id, k, nth, edit, role, CASE WHEN edit = 'I' THEN '' ELSE text END AS text,
            max(CASE WHEN edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS led
        FROM placed p LEFT JOIN symbols s ON s.conv_id IS NOT DISTINCT FROM p.conv_id AND s.i = p.i),
    repaired AS (
        SELECT conv_id, sha256(string_agg(
            CASE WHEN edit = 'K' THEN role WHEN (nth - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY k)) AS digest
        FROM edited WHERE edit <> 'D' GROUP BY conv_id),
    facts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (found = 'blank') AS blank, count(*) FILTER (found = 'duplicate') AS duplicate,
            count(*) FILTER (found = 'truncated') AS truncated,
            count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
        FROM judged GROUP BY conv_id)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
        coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
        coalesce(best.a, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN repaired ON repaired.conv_id IS NOT DISTINCT FROM c.conv_id"""


ORACLES: dict[str, str] = {
    "op2_license_scan": _licenses(),
    "op3_minhash_near_dedup": _NEAR,
    "op6_quality_rules": _quality(),
    "op8_benchmark_decontamination": _decontamination(),
    "op9_chat_formatting": _chat(),
    "op11_importance_resampling": _importance(),
    "op12_substring_dedup": _SUBSTRINGS,
    "op13_conversation_repair": _repair(),
}
