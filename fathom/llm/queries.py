"""Queries of the operators, with the parameters a production run would use.

Each is thin: it applies one operator to its whole table and derives the
columns that its contract names. ``ORACLE`` has DuckDB SQL where SQL can
express the result on whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, crf, decontam, iblt, lexical, licenses, mixing, structure, toxicity
from .common import materialize, table
from .labelled import held_out
from .neardup import near_duplicates
from .packing import pack
from .substring import drop_repeats
from .token_index import encode_and_read


QUALITY_THRESHOLD = 0.3
TOXIC_THRESHOLD = 0.5


def op1_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_read(table(spark, sf_dir, "documents", "doc_id", "text"))


def _scored(scored: DataFrame, score: str, threshold: float) -> DataFrame:
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(score).alias("score"),
                         (F.col(score) >= threshold).cast("int").alias("predicted"))


def op2_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = crf.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return _scored(crf.score(docs, model), "quality_score", QUALITY_THRESHOLD)


def op5_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return _scored(toxicity.score(docs, model), "toxic_score", TOXIC_THRESHOLD)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.fingerprint_edits(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document and benchmark item whose passage it holds."""
    found = decontam.contaminated(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.drop("th")


def op8_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document and licence rule that matches."""
    return licenses.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    more = spark.sql(f"SELECT -1L AS conv_id, n AS turn, r AS role, '{control}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(n, r)")
    return chat.digests(materialize(chat.format_windows(turns.unionByName(more)), "chat"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return structure.summaries(structure.damage(turns))


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op13_lexical_balltree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_index, op2_crf_quality, op3_best_fit_packing, op4_substring_dedup, op5_ftrl_toxicity,
                              op6_iblt_fingerprints, op7_benchmark_decontamination, op8_license_rules, op9_simhash_bktree,
                              op10_chat_windows, op11_structure_repair, op12_source_mixing, op13_lexical_balltree)
}

def _license_sql() -> str:
    """Sentences, identifiers and rules (longest first) in DuckDB SQL."""
    known = ", ".join(f"('{licenses.normal(text)}', '{name}')" for name, text in licenses.SENTENCES.items())
    ordered = sorted(licenses.RULES, key=lambda r: (-len(r[2]), r[0]))
    steps, counted = [], []
    for k, (rule, licence, ids) in enumerate(ordered):
        pattern = "".join(f"<{i}>" for i in ids)
        steps.append(f"step{k + 1} AS (SELECT *, replace(seq{k}, '{pattern}', '|') AS seq{k + 1} FROM step{k})")
        counted.append(f"SELECT doc_id, '{licence}' AS license_id, '{rule}' AS rule, CAST((length(seq{k}) - length(replace(seq{k}, '{pattern}', ''))) "
                       f"// {len(pattern)} AS INTEGER) AS n_matches, n_sentences FROM step{len(ordered)}")
    return f"""
        WITH known(body, id) AS (VALUES {known}),
        cut AS (SELECT doc_id, unnest(string_split(replace(coalesce(text, ''), '. ', '.' || chr(10)), chr(10))) AS s,
                       generate_subscripts(string_split(replace(coalesce(text, ''), '. ', '.' || chr(10)), chr(10)), 1) AS pos FROM documents),
        normed AS (SELECT doc_id, pos, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) AS body FROM cut),
        step0 AS (SELECT doc_id, string_agg('<' || id || '>', '' ORDER BY pos) AS seq0, CAST(count(*) AS INTEGER) AS n_sentences
                  FROM normed JOIN known USING (body) GROUP BY doc_id),
        {", ".join(steps)}
        SELECT * FROM ({" UNION ALL ".join(counted)}) WHERE n_matches > 0
    """


def _chat_sql() -> str:
    """The same digests from the table itself; the formatted length from the windows' members."""
    body = r"replace(text, '\', '\\')"
    for c in chat.CONTROLS:
        body = f"replace({body}, '{c}', '{c[0]}' || chr(92) || '{c[1:]}')"
    body = body.replace(r"'\\'", "chr(92) || chr(92)").replace(r"'\'", "chr(92)")
    named = body.replace("(text,", "(role,", 1)
    marks = " ".join(f"WHEN '{r}' THEN {len(a) + len(b)}" for r, (a, b) in chat.MARKS.items())
    return f"""
        WITH given AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), sized AS (
            SELECT *, 1 + len(list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS tokens,
                   length({body}) + CASE role {marks} ELSE length({named}) + {len("<<ROLE>><<TEXT>><</ROLE>>")} END AS written,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS no
            FROM given
        ), placed AS (
            SELECT *, coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_token
            FROM sized
        ), roomy AS (
            SELECT *, min(CASE WHEN role = 'system' THEN no END) OVER (PARTITION BY conv_id) AS system_no,
                   greatest({chat.BUDGET - chat.HISTORY} - coalesce(arg_min(tokens, CASE WHEN role = 'system' THEN no END) OVER (PARTITION BY conv_id), 0), 2) AS room
            FROM placed
        ), run_of AS (
            SELECT *, max(CASE WHEN begins THEN at_token END) OVER (PARTITION BY conv_id ORDER BY no) AS run
            FROM (SELECT *, tokens * 2 > room OR coalesce(lag(tokens * 2 > room) OVER (PARTITION BY conv_id ORDER BY no), true) AS begins FROM roomy)
        ), turns AS (
            SELECT *, min(no) OVER (PARTITION BY conv_id, run, (at_token - run) // cell) AS win
            FROM (SELECT *, greatest(room - max(tokens) OVER (PARTITION BY conv_id, run), 1) AS cell FROM run_of)
        ), windows AS (
            SELECT conv_id, win, min(at_token) AS first_token FROM turns GROUP BY conv_id, win
        ), lengths AS (
            SELECT w.conv_id, CAST(sum(t.written) AS BIGINT) AS formatted_chars
            FROM windows w JOIN turns t ON t.conv_id = w.conv_id AND (t.win = w.win OR (t.win < w.win AND
                 (t.at_token >= w.first_token - {chat.HISTORY} OR t.no = t.system_no)))
            GROUP BY w.conv_id
        ), said AS (
            SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY no)) AS turns_sha256,
                   coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY no), '') AS goals
            FROM turns GROUP BY conv_id
        )
        SELECT conv_id, n_turns, turns_sha256, CAST(length(goals) AS BIGINT) AS loss_chars, sha256(goals) AS loss_sha256, formatted_chars
        FROM said JOIN lengths USING (conv_id)
    """


def _repair_sql() -> str:
    """Damage, faults and the cheapest edits: a table of the best (cost, initials) by grammar state, from the last row to the first."""
    keep, put = {"s": (1, 0, 0, 0), "u": (2, 2, 0, 2), "a": (0, 0, 3, 0)}, (2, 2, 3, 2)  # 0: not possible
    cell = lambda q: f"b[{q + 1}]"
    candidate = lambda cost, edit, q: f"{{'c': {cost} + {cell(q)}.c, 'e': '{edit}' || {cell(q)}.e}}"
    none = "{'c': 1000000000, 'e': ''}"

    def consumed(q: int) -> str:
        kept = " ".join(f"WHEN NOT must AND initial = '{r}' THEN {candidate('dear', 'K', t[q])}" for r, t in keep.items() if t[q])
        given = f"CASE WHEN must THEN {none} ELSE {candidate('3 + dear', 'R', put[q])} END"
        return f"list_sort([{candidate('4', 'D', q)}, CASE {kept} ELSE {none} END, {given}])[1]"

    insert = lambda: "[" + ", ".join(f"list_sort([{cell(q)}, {candidate('3', 'I', put[q])}])[1]" for q in range(4)) + "]"
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
        WITH RECURSIVE given AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations
        ), hashed AS (
            SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(name) + 1), lambda i: CAST(ascii(substr(name, CAST(i AS INTEGER), 1)) AS BIGINT))),
                   lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                                                 lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)), CAST(4294967295 AS BIGINT)) % 20 AS kind
            FROM given
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM hashed
        ), numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS no, trim(text, {blanks}) AS said FROM damaged
        ), judged AS (
            SELECT *, said = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY no) > 1 AS again, right(said, 1) NOT IN ('.', '!', '?') AS broken,
                   lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY no) || left(role, 1) AS pair, count(*) OVER (PARTITION BY conv_id) AS n FROM numbered
        ), letters AS (
            SELECT conv_id, no, n, role, text, left(role, 1) AS initial, blank OR again AS must, CASE WHEN broken THEN 3 ELSE 0 END AS dear FROM judged
        ), best AS (
            SELECT conv_id, n AS left_rows, [{{'c': 0, 'e': ''}}, {{'c': 6, 'e': 'II'}}, {{'c': 3, 'e': 'I'}}, {{'c': 0, 'e': ''}}] AS b FROM (SELECT DISTINCT conv_id, n FROM letters)
            UNION ALL
            SELECT conv_id, left_rows, {insert()} FROM (SELECT conv_id, left_rows, {insert()} AS b FROM (
                SELECT conv_id, left_rows - 1 AS left_rows, [{", ".join(consumed(q) for q in range(4))}] AS b
                FROM best JOIN letters USING (conv_id) WHERE no = left_rows))
        ), chosen AS (
            SELECT conv_id, b[1].c AS cost, b[1].e AS audit FROM best WHERE left_rows = 0
        ), edits AS (
            SELECT conv_id, k, substr(audit, CAST(k AS INTEGER), 1) AS edit, length(replace(substr(audit, 1, CAST(k AS INTEGER)), 'I', '')) AS no
            FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS k FROM chosen)
        ), kept AS (
            SELECT e.conv_id, k, edit, CASE WHEN edit = 'K' THEN role END AS role, CASE WHEN edit = 'I' THEN '' ELSE text END AS text,
                   max(CASE WHEN edit = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS led,
                   row_number() OVER (PARTITION BY e.conv_id ORDER BY k) AS place
            FROM edits e LEFT JOIN letters l ON l.conv_id = e.conv_id AND l.no = e.no AND e.edit <> 'I' WHERE edit <> 'D'
        ), texts AS (
            SELECT conv_id, string_agg(coalesce(role, CASE WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY k) AS body
            FROM kept GROUP BY conv_id
        ), counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
                   count(*) FILTER (broken AND NOT again AND NOT blank) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id
        )
        SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
               CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
               coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM given) LEFT JOIN counted USING (conv_id) LEFT JOIN chosen USING (conv_id) LEFT JOIN texts USING (conv_id)
    """


ORACLE: dict[str, str] = {
    "op4_substring_dedup": r"""
        WITH words AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
        ), windows AS (
            SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS body
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13)
        ), earliest AS (
            SELECT body, min(doc_id) AS least FROM windows GROUP BY body
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos
            FROM windows JOIN earliest USING (body) WHERE doc_id > least
        ), marks AS (
            SELECT doc_id, list(pos) AS marked FROM gone GROUP BY doc_id
        ), judged AS (
            SELECT doc_id, w, coalesce(marked, []) AS marked,
                   list_filter(list_zip(w, range(1, len(w) + 1)), lambda p: NOT list_contains(coalesce(marked, []), p[2])) AS pairs
            FROM words LEFT JOIN marks USING (doc_id)
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(marked) AS BIGINT) AS n_removed,
               sha256(array_to_string(list_transform(pairs, lambda p: p[1]), ' ')) AS kept_sha256
        FROM judged
    """,
    "op8_license_rules": _license_sql(),
    "op10_chat_windows": _chat_sql(),
    "op11_structure_repair": _repair_sql(),
    "op12_source_mixing": f"""
        WITH sized AS (
            SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS size FROM documents
        ), sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * sum(size) AS most, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
            FROM sized GROUP BY source
        ), levels AS (
            SELECT *, sum(source_size) OVER () - coalesce(sum(most) OVER (up ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spare,
                   sum(weight) OVER (up ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free, row_number() OVER up AS no
            FROM sources WINDOW up AS (ORDER BY most / weight, source NULLS LAST)
        ), level AS (
            SELECT CAST(spare AS DOUBLE) AS spare, CAST(free AS DOUBLE) AS free, no FROM levels
            WHERE most * free >= weight * spare ORDER BY no LIMIT 1
        ), targets AS (
            SELECT l.source, source_size, CASE WHEN v.no IS NULL OR l.no < v.no THEN CAST(most AS DOUBLE) ELSE weight * v.spare / v.free END AS target
            FROM levels l LEFT JOIN level v ON true
        ), placed AS (
            SELECT doc_id, size, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS words,
                   coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15), doc_id
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_word
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(CASE WHEN size = 0 THEN 0 ELSE
            (words // source_size) * size + greatest(0, least(size, words % source_size - at_word)) END AS BIGINT) AS taken
        FROM placed
    """,
    "op13_lexical_balltree": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents WHERE text IS NOT NULL
        ), docs AS (
            SELECT row_number() OVER () AS row_no, doc_id, len(w) AS n, w FROM words WHERE len(w) > 0
        ), corpus AS (
            SELECT count(*) AS total, CAST(sum(n) AS BIGINT) AS length FROM docs
        ), asked AS (
            SELECT item_id, t, count(*) AS repeats FROM (
                SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
                FROM benchmark) GROUP BY item_id, t
        ), counts AS (
            SELECT row_no, doc_id, n, t, count(*) AS tf FROM (SELECT row_no, doc_id, n, unnest(w) AS t FROM docs) GROUP BY row_no, doc_id, n, t
        ), weights AS (
            SELECT t, CAST(floor(1000 * ln(CAST(2 * max(total) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM counts, corpus GROUP BY t
        ), scored AS (
            SELECT item_id, row_no, doc_id, CAST(sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * total) // length)))) AS BIGINT) AS score
            FROM counts JOIN weights USING (t) JOIN asked USING (t), corpus GROUP BY item_id, row_no, doc_id
        ), ranked AS (
            SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST, row_no) AS rank, doc_id, score FROM scored WHERE score > 0
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
}
