"""The registered queries stated independently in SQL for DuckDB."""

from __future__ import annotations

from sentloom.constants import MAX_PAD, MAX_TOKENS, VOCAB_SIZE
from sentloom.plans.fixtures import BATCH_SIZE, DEVICES, NODES, SHARD_SIZE, SMALL_PAD, TOKENIZE_BATCH
from sentloom.plans.queries import MANY_FILES, SRC_LANG, TGT_LANG

# What stays out of translation, stated on its own.
ENTITY = (
    r"<ID[0-9]+>|https?://[^ \t\n\r<>]+|www\.[^ \t\n\r<>]+"
    r"|[A-Za-z0-9_.+-]+@[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)+|\p{Nd}+(?:[.,]\p{Nd}+)*"
)
PREFIX = f"{SRC_LANG} {TGT_LANG}"
SYMBOLS = "'@#$^&*-_+=[]{}|\\<>/'||chr(10)"
SPACES = "' '||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(133)||chr(160)"
META = "dump, url, file_path"


def _docs(files: int) -> str:
    return (
        f"SELECT doc_id % {files} AS file_no, doc_id // {files} AS row_no, CAST(doc_id AS VARCHAR) AS id, text, "
        "source AS dump, 'doc://'||doc_id AS url, source||'/'||lang AS file_path FROM documents"
    )


def _pieces(text: str, source: str, keys: str) -> str:
    """Pieces of a lower-cased text: dots that touch a digit are protected while the rest splits."""
    protected = (
        f"regexp_replace(regexp_replace({text}, '(\\p{{Nd}})\\.', '\\1'||chr(2), 'g'), '\\.(\\p{{Nd}})', chr(2)||'\\1', 'g')"
    )
    cut = (
        f"regexp_split_to_array(regexp_replace({protected}, '(\\.|[?!।|॥؟۔\\n]\\n*)', '\\1'||chr(1), 'g'), chr(1))"
    )
    return (
        f"SELECT {keys}, replace(p, chr(2), '.') AS piece, place FROM "
        f"(SELECT {keys}, unnest(l) AS p, generate_subscripts(l, 1) - 1 AS place FROM "
        f"(SELECT {keys}, {cut} AS l FROM {source})) WHERE length(p) > 0"
    )


def _clean(piece: str) -> str:
    stripped = f"trim(trim({piece}, {SYMBOLS}), {SPACES})"
    return f"trim(regexp_replace({stripped}, '^\\s*(•|○|\\*|-|[0-9]+\\.)\\s*', ''), {SPACES})"


def _sentences(pieces: str, keys: str) -> str:
    return (
        f"SELECT {keys}, row_number() OVER (PARTITION BY {keys} ORDER BY place) - 1 AS sent_idx, sentence FROM "
        f"(SELECT {keys}, place, {_clean('piece')} AS sentence FROM {pieces}) WHERE length(sentence) > 0"
    )


def _tokens(column: str, extra: str = "") -> str:
    return f"regexp_split_to_array({column}, '\\s+'){extra}"


def _vocab(source: str, column: str = "sentence", having: str = "") -> str:
    return (
        "SELECT token, n, 3 + row_number() OVER (ORDER BY n DESC, token) AS token_id FROM "
        f"(SELECT token, count(*) AS n FROM (SELECT unnest({_tokens(column)}) AS token FROM {source}) "
        f"GROUP BY token {having})"
    )


def _encode(source: str, vocab: str, max_length: int = MAX_TOKENS, keys: str = "shard, pos, id") -> str:
    return (
        f"SELECT {keys}, list(coalesce(token_id, 3) ORDER BY place) AS ids FROM "
        f"(SELECT {keys}, unnest(l) AS token, generate_subscripts(l, 1) AS place FROM "
        f"(SELECT {keys}, {_tokens('sentence', f'[1:{max_length}]')} AS l FROM {source})) "
        f"LEFT JOIN {vocab} USING (token) GROUP BY {keys}"
    )


def _labelled(size: int, max_pad: int | None, devices: int, source: str = "encoded") -> str:
    over = f"max(len(ids)) OVER b > {max_pad}" if max_pad is not None else "false"
    return (
        f"SELECT *, CASE WHEN {over} THEN 'over_length' WHEN count(*) OVER b % {devices} <> 0 THEN 'ragged' ELSE 'ok' END "
        f"AS status, max(len(ids)) OVER b AS longest FROM (SELECT *, pos // {size} AS batch_id FROM {source}) "
        "WINDOW b AS (PARTITION BY shard, batch_id)"
    )


NEIGHBOUR = "CASE WHEN x % 3 <> 0 THEN 4 + xor(x - 4, 1) ELSE x END"
GAPS = f"regexp_split_to_array(sentence, '{ENTITY}')"


def _masked(text: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_split_to_array({text}, '{ENTITY}'), "
        "lambda g, i: CASE WHEN i = 1 THEN g ELSE '<ID'||(i - 1)||'>'||g END), '')"
    )


def _scoped(tail: str) -> str:
    """Shards numbered per file: reserved and dense numbers side by side."""
    return (
        "SELECT s.*, g // {S} AS local, g % {S} AS pos, file_no * 2500 + 1 + g // {S} AS reserved, "
        "first + g // {S} AS dense FROM sent4g s JOIN (SELECT file_no, n AS total, "
        "1 + coalesce(sum({R}) OVER (ORDER BY file_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first "
        "FROM (SELECT file_no, count(*) AS n FROM sent4 GROUP BY file_no)) USING (file_no) WHERE g // {S} < {T}"
    ).format(
        S=SHARD_SIZE,
        R=f"(n + {SHARD_SIZE - 1}) // {SHARD_SIZE}" if tail == "flush" else f"n // {SHARD_SIZE}",
        T=f"(total + {SHARD_SIZE - 1}) // {SHARD_SIZE}" if tail == "flush" else f"total // {SHARD_SIZE}",
    )


KEYS = "file_no, row_no, id"

# Named steps; each may use the ones before it.
STEPS: dict[str, tuple[tuple[str, ...], str]] = {
    "docs": ((), _docs(1)),
    "docs4": ((), _docs(4)),
    "pieces": (("docs",), _pieces("lower(text)", "docs", KEYS)),
    "pieces4": (("docs4",), _pieces("lower(text)", "docs4", KEYS)),
    "sent": (("pieces",), _sentences("pieces", KEYS)),
    "sent4": (("pieces4",), _sentences("pieces4", KEYS)),
    "sent4g": (
        ("sent4",),
        "SELECT *, row_number() OVER (PARTITION BY file_no ORDER BY row_no, sent_idx) - 1 AS g FROM sent4",
    ),
    "files": (("sent4g",), _scoped("flush")),
    "files_drop": (("sent4g",), _scoped("drop")),
    "shards": (
        ("sent",),
        f"SELECT *, 1 + g // {SHARD_SIZE} AS shard, g % {SHARD_SIZE} AS pos FROM "
        "(SELECT *, row_number() OVER (ORDER BY file_no, row_no, sent_idx) - 1 AS g FROM sent)",
    ),
    "counts": (
        ("docs", "sent"),
        "SELECT d.*, row_number() OVER (ORDER BY file_no, row_no) - 1 AS ord, coalesce(n, 0) AS n, "
        "coalesce(sum(coalesce(n, 0)) OVER (ORDER BY file_no, row_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
        "::BIGINT AS start FROM docs d LEFT JOIN (SELECT id, count(*) AS n FROM sent GROUP BY id) USING (id)",
    ),
    "meta": (
        ("docs", "shards"),
        f"SELECT DISTINCT shard, id, {META}, row_no AS ord FROM shards JOIN docs USING (file_no, row_no, id)",
    ),
    "islands": (
        ("shards",),
        "SELECT *, CAST(sum(starts) OVER (PARTITION BY shard ORDER BY pos) - 1 AS BIGINT) AS island FROM (SELECT *, CASE WHEN id IS NOT "
        "DISTINCT FROM lag(id) OVER (PARTITION BY shard ORDER BY pos) THEN 0 ELSE 1 END AS starts FROM shards)",
    ),
    "vocab": (("shards",), _vocab("shards")),
    "encoded": (("shards", "vocab"), _encode("shards", "vocab")),
    "small": (("shards",), _vocab("shards") + " QUALIFY token_id < 504"),
    "labelled": (("encoded",), _labelled(BATCH_SIZE, None, DEVICES)),
    "short": (("encoded",), _labelled(TOKENIZE_BATCH, MAX_PAD, 1)),
    "translated": (
        ("labelled",),
        f"SELECT *, CASE WHEN status = 'ok' THEN list_transform(ids, lambda x: {NEIGHBOUR}) END AS out FROM labelled",
    ),
    "whole": (("encoded",), f"SELECT *, list_transform(ids, lambda x: {NEIGHBOUR}) AS out FROM encoded"),
    "decoded": (
        ("whole", "vocab"),
        "SELECT shard, pos, id, string_agg(coalesce(token, '<unk>'), ' ' ORDER BY place) AS sentence FROM "
        "(SELECT shard, pos, id, unnest(out) AS token_id, generate_subscripts(out, 1) AS place FROM whole) "
        "LEFT JOIN vocab USING (token_id) GROUP BY shard, pos, id",
    ),
    # Ids are unique in the fixture, so a run is a document inside a shard.
    "regrouped": (
        ("decoded",),
        "SELECT shard, id AS uuid, string_agg(sentence, chr(10) ORDER BY pos) AS text, count(*) AS n, "
        "row_number() OVER (PARTITION BY shard ORDER BY min(pos)) - 1 AS island FROM decoded GROUP BY shard, id",
    ),
    "pieces_out": (
        ("regrouped", "docs"),
        f"SELECT shard, island, uuid, r.text, n, {META} FROM regrouped r JOIN docs ON docs.id = uuid",
    ),
    "tagged": (("shards",), f"SELECT shard, pos, id, '{PREFIX} '||{_masked('sentence')} AS sentence FROM shards"),
    "tagged_vocab": (("tagged",), _vocab("tagged")),
    "prepared": (("tagged", "tagged_vocab"), _encode("tagged", "tagged_vocab")),
    "tagged_top": (("tagged",), _vocab("tagged") + f" QUALIFY token_id < {4 + VOCAB_SIZE}"),
    "prepared_top": (("tagged", "tagged_top"), _encode("tagged", "tagged_top")),
    "prepared_labelled": (("prepared",), _labelled(BATCH_SIZE, MAX_PAD, DEVICES, "prepared")),
    "done": (("shards",), "SELECT DISTINCT shard FROM shards WHERE shard <= 7 OR shard % 3 = 0"),
}


def _sql(select: str, *steps: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for needed in STEPS[name][0]:
            add(needed)
        if name not in order:
            order.append(name)

    for step in steps:
        add(step)
    if not order:
        return select
    return "WITH " + ", ".join(f"{n} AS ({STEPS[n][1]})" for n in order) + " " + select


def _text(ids: str, alias: str) -> str:
    return f"array_to_string({ids}, ' ') AS {alias}"


def _padded(ids: str = "ids", pad: int = 1) -> str:
    return f"list_concat(list_transform(range(longest - len(ids)), lambda x: {pad}), {ids})"


ONES = "list_transform(ids, lambda x: 1)"
MEASURED = "(4 + length(sentence) % 1000)||' '||(4 + length(sentence) - length(replace(sentence, ' ', '')))"
CUT = f"count_if(len({_tokens('sentence')}) > {MAX_TOKENS})"
LABELLED_SENTENCES = "labelled JOIN (SELECT shard, pos, sentence FROM shards) USING (shard, pos)"
REFUSED = "contains(sentence, 'ñ')"

ORACLES: dict[str, str] = {
    "s1_scan_corpus": _sql(f"SELECT id, text, {META} FROM docs", "docs"),
    "s2_numbered_files": _sql(
        'SELECT row_no AS "row", id, printf(\'train-%05d-of-00004.parquet\', file_no) AS name, '
        "file_no AS parsed FROM docs4", "docs4",
    ),
    "s3_read_tokens": _sql(
        f"SELECT shard, pos, id, {_text(_padded(), 'input_ids')}, {_text(_padded(ONES, 0), 'attention_mask')}, "
        "sentence AS entity FROM (" + _labelled(TOKENIZE_BATCH, None, 1) + ") JOIN (SELECT shard, pos, sentence FROM shards) "
        f"USING (shard, pos) WHERE shard % {NODES} = 1", "encoded",
    ),
    "s4_list_shards": _sql(f"SELECT DISTINCT shard % {NODES} AS node, shard FROM shards", "shards"),
    "s5_shard_range": _sql(
        f"SELECT shard, row_number() OVER (PARTITION BY shard ORDER BY pos) - 1 AS pos, id, {_text('out', 'output_ids')} "
        "FROM whole WHERE shard >= 3", "whole",
    ),
    "s5_shard_range_sparse": _sql(
        "SELECT shard * 2500 + 1 AS shard, row_number() OVER (PARTITION BY shard ORDER BY pos) - 1 AS pos, id, "
        f"{_text('out', 'output_ids')} FROM whole WHERE shard >= 2", "whole",
    ),
    "s7_read_documents": _sql(
        f"SELECT uuid, text, {META} FROM pieces_out WHERE shard % {NODES} BETWEEN 1 AND 2", "pieces_out"
    ),
    "k1_write_shards": _sql(
        f"SELECT shard % {NODES} AS node, shard, count(*) AS rows FROM shards GROUP BY shard", "shards"
    ),
    "k1_write_payloads": _sql(
        f'SELECT shard % {NODES} AS node, shard, CASE WHEN count(*) = {SHARD_SIZE} THEN max(row_no) + 1 ELSE '
        f'(SELECT count(*) FROM docs) END AS "row", max(pos) // {TOKENIZE_BATCH} + 1 AS batches, '
        "count(DISTINCT id) AS listed FROM shards GROUP BY shard", "shards",
    ),
    "k2_write_documents": _sql(
        f'SELECT shard % {NODES} AS node, shard, "row", count(*) AS documents FROM regrouped JOIN (SELECT shard, '
        f'CASE WHEN count(*) = {SHARD_SIZE} THEN max(row_no) + 1 ELSE (SELECT count(*) FROM docs) END AS "row" '
        'FROM shards GROUP BY shard) USING (shard) GROUP BY shard, "row"', "regrouped",
    ),
    "s6_progress": _sql(
        'SELECT (SELECT count(*) FROM docs) AS "row", count(*) AS sentences, '
        f"count(*) // {SHARD_SIZE} + 1 AS shard FROM sent", "docs", "sent",
    ),
    "k4_retire_inputs": _sql(
        f"SELECT DISTINCT shard % {NODES} AS node, shard FROM shards WHERE shard NOT IN (SELECT shard FROM done)",
        "shards", "done",
    ),
    "k4_retire_keeps_unresolved": _sql(
        f"SELECT DISTINCT shard % {NODES} AS node, shard FROM labelled WHERE status <> 'ok'", "labelled"
    ),
    "p7_rows_in_all_lists": _sql(
        f"SELECT uuid, text, {META} FROM pieces_out WHERE shard % 2 = 0", "pieces_out"
    ),
    "k5_publish": _sql(f"SELECT uuid, text, {META} FROM pieces_out", "pieces_out"),
    "p1_metadata": _sql(f"SELECT id, {META} FROM docs", "docs"),
    "p2_drop_empty": _sql(
        "SELECT id, coalesce(p, 0) AS pieces, coalesce(s, 0) AS sentences FROM docs LEFT JOIN "
        "(SELECT id, count(*) AS p FROM pieces GROUP BY id) USING (id) LEFT JOIN "
        "(SELECT id, count(*) AS s FROM sent GROUP BY id) USING (id)", "docs", "sent",
    ),
    "p3_resume_skip": _sql(
        'SELECT file_no, row_no AS "row", id, \'exact\' AS rule FROM docs4 WHERE row_no >= 20 UNION ALL '
        'SELECT file_no, row_no AS "row", id, \'compat\' AS rule FROM docs4 WHERE row_no >= 19', "docs4",
    ),
    "p4_node_filter": _sql(
        f"SELECT shard % {NODES} AS node, shard, pos, id FROM shards WHERE shard % {NODES} IN (1, 2)", "shards"
    ),
    "p5_over_length": _sql(
        f"SELECT shard, pos, batch_id, id, status FROM ({_labelled(TOKENIZE_BATCH, SMALL_PAD, 1)})", "encoded"
    ),
    "p6_ragged": _sql(
        f"SELECT shard, pos, batch_id, id, status FROM ({_labelled(BATCH_SIZE, MAX_PAD, DEVICES)})", "encoded"
    ),
    "p8_skip_empty_outputs": _sql("SELECT shard, pos, id FROM translated WHERE status = 'ok'", "translated"),
    "j1_meta_lookup": _sql(
        f"SELECT DISTINCT shard, island, islands.id AS uuid, {META} FROM islands JOIN docs USING (id)", "islands", "docs"
    ),
    "j1_last_meta_wins": _sql(
        "SELECT shard, id, CASE WHEN ord % 2 = 0 THEN 'later' ELSE dump END AS dump, url, file_path FROM meta", "meta"
    ),
    "j1_missing_meta": _sql(
        "SELECT DISTINCT shard, i.id AS uuid, CASE WHEN i.id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels) "
        "THEN 'doc://'||i.id END AS url FROM shards i", "shards",
    ),
    "j2_pending_shards": _sql(
        "SELECT DISTINCT shard FROM shards WHERE shard NOT IN (SELECT shard FROM done)", "shards", "done"
    ),
    "j3_new_shards": _sql(
        f"SELECT DISTINCT shard % {NODES} AS node, shard FROM shards WHERE shard % {NODES} NOT IN (0, 3)", "shards"
    ),
    "j4_zip_shortest": _sql(
        "SELECT a.id, a.sentence AS text, length(b.sentence) AS next_length, '> '||c.sentence AS quoted FROM sent a "
        "JOIN sent b ON a.id = b.id AND b.sent_idx = a.sent_idx + 1 JOIN (SELECT id, sentence, row_number() OVER "
        "(PARTITION BY id ORDER BY sent_idx) - 1 AS k FROM sent WHERE length(sentence) > 30) c "
        "ON a.id = c.id AND c.k = a.sent_idx", "sent",
    ),
    "j5_token_ids": _sql(
        "SELECT shard, pos, place - 1 AS place, token_id FROM (SELECT shard, pos, unnest(l) AS token, "
        f"generate_subscripts(l, 1) AS place FROM (SELECT shard, pos, {_tokens('sentence')} AS l FROM shards)) "
        "JOIN vocab USING (token)", "vocab",
    ),
    "j6_lexicon_translation": _sql(f"SELECT shard, pos, status, {_text('out', 'output_ids')} FROM translated", "translated"),
    "j6_lexicon_by_join": _sql(f"SELECT shard, pos, status, {_text('out', 'output_ids')} FROM translated", "translated"),
    "a1_regroup": _sql(
        "SELECT shard, island, id AS uuid, string_agg(sentence, chr(10) ORDER BY pos) AS text FROM islands "
        "GROUP BY shard, island, id", "islands",
    ),
    "a2_sentence_counts": _sql(
        "SELECT docs.id, count(sent.id) AS n_sentences FROM docs LEFT JOIN sent USING (id) GROUP BY docs.id", "docs", "sent"
    ),
    "a3_batch_lengths": _sql(
        f"SELECT shard, pos // {BATCH_SIZE} AS batch_id, max(len(ids)) AS longest, count(*) AS batch_rows FROM encoded "
        "GROUP BY ALL", "encoded",
    ),
    "a4_shard_bounds": _sql("SELECT min(shard) AS lowest, max(shard) AS highest FROM shards", "shards"),
    "a5_vocabulary": _sql("SELECT token, n, token_id FROM vocab", "vocab"),
    "a5_vocabulary_top": _sql("SELECT token, n, token_id FROM vocab WHERE token_id < 1004", "vocab"),
    "a5_vocabulary_of_pages": _vocab(
        f"(SELECT trim(lower(html), {SPACES}) AS html FROM pages)", "html", "HAVING count(*) >= 3"
    ),
    "a6_alignment_audit": _sql(
        "SELECT shard, count(*) AS rows, count(*) AS ids, count(*) AS inputs, count(*) AS masks, count(*) AS maps, "
        "0 AS uneven, true AS ok FROM shards GROUP BY shard", "shards",
    ),
    "a7_run_report": _sql(
        "SELECT shard, status, count(*) AS rows, count(DISTINCT batch_id) AS batches, CAST(sum(CASE WHEN "
        f"len({_tokens('sentence')}) > {MAX_TOKENS} THEN 1 ELSE 0 END) AS BIGINT) AS truncated "
        "FROM labelled JOIN (SELECT shard, pos, sentence FROM shards) USING (shard, pos) GROUP BY shard, status",
        "labelled",
    ),
    "a8_total_shards": _sql("SELECT count(DISTINCT shard) AS shards FROM shards", "shards"),
    "w1_ordinals": _sql("SELECT id, ord, start, n AS n_sentences FROM counts", "counts"),
    "w2_shard_ids": _sql("SELECT shard, pos, id, sent_idx, sentence FROM shards", "shards"),
    "w2_file_numbering": _sql("SELECT reserved AS shard, pos, id, sent_idx FROM files", "files"),
    "w2_dense_file_numbering": _sql("SELECT dense AS shard, pos, id, sent_idx FROM files", "files"),
    "w3_tail_dropped": _sql(
        f"SELECT shard, count(*) AS rows FROM shards GROUP BY shard HAVING count(*) = {SHARD_SIZE}", "shards"
    ),
    "w3_file_tails_dropped": _sql("SELECT dense AS shard, count(*) AS rows FROM files_drop GROUP BY dense", "files_drop"),
    "w4_islands": _sql(
        "SELECT source, shard, pos, id, CAST(sum(starts) OVER (PARTITION BY shard ORDER BY pos) - 1 AS BIGINT) AS island "
        "FROM (SELECT *, CASE WHEN id IS NOT DISTINCT FROM lag(id) OVER (PARTITION BY shard ORDER BY pos) "
        "AND row_number() OVER (PARTITION BY shard ORDER BY pos) > 1 THEN 0 ELSE 1 END AS starts FROM "
        "(SELECT 'turns' AS source, conv_id AS shard, turn AS pos, role AS id FROM conversations UNION ALL "
        "SELECT 'shards', shard + 1000000000, pos, id FROM shards))", "shards",
    ),
    "w5_batches": _sql(f"SELECT shard, pos, pos // {TOKENIZE_BATCH} AS batch_id FROM shards", "shards"),
    "w6_watermarks": _sql(
        f'SELECT reserved AS shard, CASE WHEN count(*) = {SHARD_SIZE} THEN max(row_no) + 1 ELSE (SELECT max(row_no) + 1 '
        'FROM docs4 WHERE docs4.file_no = files.file_no) END AS "row" FROM files GROUP BY reserved, file_no', "files",
    ),
    "w7_shard_meta": _sql(
        f"SELECT shard, ord, id, {META} FROM (SELECT *, unnest(range(start // {SHARD_SIZE}, CASE WHEN n > 0 THEN "
        f"(start + n - 1) // {SHARD_SIZE} ELSE start // {SHARD_SIZE} END + 1)) + 1 AS shard FROM counts) "
        f"WHERE shard <= (SELECT max(shard) FROM shards)", "counts", "shards",
    ),
    "w8_frontier": _sql(
        "SELECT coalesce((SELECT min(shard) FROM shards WHERE shard NOT IN (SELECT shard FROM done)), "
        "(SELECT max(shard) + 1 FROM shards)) AS shard", "shards", "done",
    ),
    "w9_plan_work": _sql(
        "SELECT (shard - lowest) % 3 AS worker, shard FROM (SELECT min(reserved) AS lowest, "
        "unnest(range(min(reserved), max(reserved) + 1)) AS shard FROM files) WHERE shard NOT IN (SELECT shard FROM done)",
        "files", "done",
    ),
    "t1_numeric_order": _sql(
        f"SELECT DISTINCT 'a/'||(shard % {NODES})||'/tokenized/'||shard||'.json' AS path, shard, shard % {NODES} AS node "
        "FROM shards", "shards",
    ),
    "t2_flatten": _sql("SELECT shard, pos, id FROM shards", "shards"),
    "t3_union_of_nodes": _sql(
        "SELECT uuid, count(*) AS parts, CAST(sum(n) AS BIGINT) AS sentences FROM regrouped GROUP BY uuid", "regrouped"
    ),
    "f1_normalize": _sql("SELECT id, lower(text) AS text FROM docs", "docs"),
    "f1_normalize_wide": _sql("SELECT id, lower(text) AS text FROM docs", "docs"),
    "f2_split_pieces": _sql("SELECT id, row_number() OVER (PARTITION BY id ORDER BY place) - 1 AS place, piece FROM pieces", "pieces"),
    "f3_strip_symbols": f"SELECT page_id, trim(html, {SYMBOLS}) AS html FROM pages",
    "f4_strip_whitespace": _sql(
        f"SELECT id, trim(unnest(string_split(text, '.')), {SPACES}) AS text FROM docs", "docs"
    ),
    "f5_strip_bullet": _sql(
        "SELECT id, place, regexp_replace(list_extract(['', ' • ', '○', '* ', '- ', '12. ', '3 '], place % 7 + 1)||line, "
        "'^\\s*(•|○|\\*|-|[0-9]+\\.)\\s*', '') AS line FROM (SELECT id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS place "
        "FROM (SELECT id, string_split(text, chr(10)) AS l FROM docs))", "docs",
    ),
    "f6_clean_sentences": _sql("SELECT id, sent_idx, sentence FROM sent", "sent"),
    "f6_dedup_sentences": _sql(
        "SELECT id, row_number() OVER (PARTITION BY id ORDER BY sent_idx) - 1 AS sent_idx, sentence FROM (SELECT *, "
        "row_number() OVER (PARTITION BY id, sentence ORDER BY sent_idx) AS k FROM sent) WHERE k = 1", "sent",
    ),
    "f6_conversation_sentences": (
        "WITH turns AS (SELECT conv_id, turn, lower(text) AS text FROM conversations), cut AS ("
        + _pieces("text", "turns", "conv_id, turn") + "), kept AS (" + _sentences("cut", "conv_id, turn")
        + ') SELECT conv_id AS file_no, turn AS "row", sent_idx, sentence FROM kept'
    ),
    "f8_shard_of_path": _sql(
        f"SELECT DISTINCT 'b/n/s/'||(shard % {NODES})||'/tokenized/'||shard||'.json' AS path, shard, "
        f"shard % {NODES} AS node FROM shards", "shards",
    ),
    "f9_file_names": _sql(
        'SELECT row_no AS "row", printf(\'train-%05d-of-00099.parquet\', row_no) AS name, printf(\'%03d\', row_no) AS short '
        "FROM docs", "docs",
    ),
    "f11_language_tags": _sql(
        f"SELECT shard, pos, '{PREFIX} '||sentence AS tagged, sentence AS bare FROM shards", "shards"
    ),
    "f12_mask_entities": _sql(
        f"SELECT shard, pos, {_masked('sentence')} AS sentence, array_to_string(list_transform(found, lambda e, i: "
        "'<ID'||i||'>'), ' ') AS placeholders, array_to_string(found, ' ') AS entities FROM (SELECT *, "
        f"regexp_extract_all(sentence, '{ENTITY}') AS found FROM shards)", "shards",
    ),
    "f12_mask_pages": (
        f"SELECT page_id, {_masked('text')} AS masked, text AS sentence FROM "
        "(SELECT page_id, 'see '||url||' now' AS text FROM pages)"
    ),
    "f12_unmask_entities": _sql("SELECT shard, pos, sentence FROM shards", "shards"),
    "f20_encode": _sql(f"SELECT shard, pos, id, {_text('ids', 'input_ids')} FROM encoded", "encoded"),
    "f20_encode_by_join": _sql(f"SELECT shard, pos, id, {_text('ids', 'input_ids')} FROM encoded", "encoded"),
    "f20_encode_small_vocabulary": _sql(
        f"SELECT shard, pos, {_text('ids', 'input_ids')} FROM ({_encode('shards', 'small', 10)})", "small"
    ),
    "f21_attention_mask": _sql(f"SELECT shard, pos, {_text(ONES, 'attention_mask')} FROM encoded", "encoded"),
    "f22_left_pad": _sql(
        f"SELECT shard, pos, {_text(_padded(), 'input_ids')}, {_text(_padded(ONES, 0), 'attention_mask')} FROM short", "short"
    ),
    "f25_shift_right": _sql(
        "SELECT shard, pos, array_to_string(list_concat([2], list_transform(ids, lambda x: CASE WHEN x % 5 = 0 THEN 1 "
        "ELSE x END)[:-2]), ' ') AS shifted FROM encoded", "encoded",
    ),
    "f26_position_ids": _sql(
        f"SELECT shard, pos, {_text(_padded('range(2, len(ids) + 2)'), 'positions')} FROM short", "short"
    ),
    "f26_position_ids_inner_pads": _sql(
        "SELECT shard, pos, string_agg(CAST(CASE WHEN real = 0 THEN 1 ELSE k + 7 + 1 END AS VARCHAR), ' ' ORDER BY place) "
        "AS positions FROM (SELECT *, sum(real) OVER (PARTITION BY shard, pos ORDER BY place)::BIGINT AS k FROM (SELECT shard, pos, "
        "generate_subscripts(ids, 1) AS place, CASE WHEN unnest(ids) % 3 = 0 THEN 0 ELSE 1 END AS real FROM encoded)) "
        "GROUP BY shard, pos", "encoded",
    ),
    "f27_mask_positions": _sql(
        f"SELECT shard, pos, {_text(_padded('range(len(ids))', -1), 'positions')} FROM short", "short"
    ),
    "f28_row_positions": _sql(f"SELECT shard, pos, {_text('range(len(ids))', 'positions')} FROM encoded", "encoded"),
    "f30_decode": _sql("SELECT shard, pos, id, sentence FROM decoded", "decoded"),
    "f40_node_route": _sql(f"SELECT DISTINCT shard, shard % {NODES} AS node FROM shards", "shards"),
    "f41_shard_base": _sql("SELECT DISTINCT file_no, file_no * 2500 + 1 AS first_shard FROM docs4", "docs4"),
    "f42_json_round_trip": _sql(
        f"SELECT shard, pos, id, {_text(_padded(), 'input_ids')} FROM ({_labelled(TOKENIZE_BATCH, None, 1)})", "encoded"
    ),
    "u1_translate_batches": _sql(
        "SELECT shard, pos, status, CASE WHEN status = 'ok' THEN array_to_string(list_reverse(ids), ' ') END AS output_ids "
        "FROM labelled", "labelled",
    ),
    "u2_failed_batches": _sql(
        "SELECT shard, pos, CASE WHEN longest % 2 = 0 THEN 'failed' ELSE 'ok' END AS status, "
        "CASE WHEN longest % 2 = 0 THEN 'RuntimeError: even width' END AS error, "
        "CASE WHEN longest % 2 = 1 THEN array_to_string(list_reverse(ids), ' ') END AS output_ids "
        f"FROM ({_labelled(TOKENIZE_BATCH, None, 1)})", "encoded",
    ),
    "x1_drain": _sql(
        "SELECT shard, pos, 'ok' AS status, array_to_string(list_transform(ids, lambda x: " + NEIGHBOUR + "), ' ') AS output_ids "
        "FROM encoded", "encoded",
    ),
    "x5_prepare_stream": _sql(
        f"SELECT (count(*) + {SHARD_SIZE - 1}) // {SHARD_SIZE} AS shards, count(*) AS sentences, "
        f"(count(*) + {SHARD_SIZE - 1}) // {SHARD_SIZE} AS dense FROM sent", "sent",
    ),
    "x5_streamed_sentences": _sql("SELECT id, sent_idx, sentence FROM sent", "sent"),
    "c1_prepare": _sql(
        f"SELECT shard, shard % {NODES} AS node, pos, pos // {TOKENIZE_BATCH} AS batch_id, id, {_text('ids', 'input_ids')} "
        "FROM prepared", "prepared",
    ),
    "c2_translate": _sql(
        f"SELECT shard, pos, batch_id, status, CASE WHEN status = 'ok' THEN array_to_string(list_transform(ids, lambda x: "
        f"{NEIGHBOUR}), ' ') END AS output_ids FROM prepared_labelled", "prepared_labelled",
    ),
    # A lexicon that knows nothing copies every token, so a document comes back as its sentences, cut
    # after the tokens that fit beside the two language tags.
    "c3_regroup": _sql(
        "SELECT id AS uuid, string_agg(s, chr(10) ORDER BY sent_idx) AS text, any_value(dump) AS dump, any_value(url) AS url, "
        "any_value(file_path) AS file_path FROM (SELECT shards.id, sent_idx, dump, url, file_path, array_to_string("
        "regexp_split_to_array(sentence, '\\s+'), ' ') AS s FROM shards JOIN docs "
        "USING (file_no, row_no, id)) GROUP BY id", "shards",
    ),
    "c3_regroup_incomplete": _sql(
        "SELECT id AS uuid, count_if(status <> 'ok') = 0 AS complete, count_if(status <> 'ok') AS missing_sentences, "
        "count_if(status = 'ok') AS sentences FROM labelled GROUP BY id", "labelled",
    ),
    "u2_quarantine_replayed": _sql(f"SELECT shard, pos, id, {_text('out', 'output_ids')} FROM whole", "whole"),
    "c3_regroup_shard_scope": _sql(f"SELECT shard, island, uuid, text, {META} FROM pieces_out", "pieces_out"),
    "c4_publish": _sql(f"SELECT uuid, text, {META} FROM pieces_out WHERE shard % {NODES} <= 1", "pieces_out"),
    "s6_progress_per_file": _sql(
        "SELECT CAST(4 AS BIGINT) AS files, (SELECT count(*) FROM docs) AS done_rows, count(*) AS sentences FROM sent", "sent", "docs"
    ),
    "k2_write_whole_documents": _sql(
        f"SELECT shard % {NODES} AS node, shard, CAST(row_number() OVER (PARTITION BY shard ORDER BY row_no) - 1 AS INTEGER) AS place, uuid, t.text, {META} "
        "FROM (SELECT id AS uuid, min(shard) AS shard, string_agg(sentence, chr(10) ORDER BY shard, pos) AS text FROM decoded GROUP BY id) t "
        "JOIN docs ON docs.id = uuid", "decoded", "docs",
    ),
    "p3_resume_per_file": _sql(
        'SELECT file_no, row_no AS "row", id FROM docs4 JOIN (SELECT file_no, count(*) AS n FROM docs4 GROUP BY file_no) USING (file_no) '
        "WHERE file_no = 3 OR row_no >= n // (file_no + 2)", "docs4",
    ),
    "u3_callable_tokenizer": _sql(f"SELECT shard, pos, id, {MEASURED} AS input_ids FROM shards", "shards"),
    "u2_failed_tokenizing": _sql(
        f"SELECT shard, pos, CASE WHEN {REFUSED} THEN 'failed' ELSE 'ok' END AS token_status, "
        f"CASE WHEN {REFUSED} THEN 'RuntimeError: refused' END AS token_error, CASE WHEN NOT {REFUSED} THEN {MEASURED} END AS input_ids, "
        f"CASE WHEN {REFUSED} THEN sentence END AS untokenized FROM shards", "shards",
    ),
    "u2_retokenized": _sql(f"SELECT shard, pos, id, {MEASURED} AS input_ids FROM shards", "shards"),
    "u2_untokenized_documents": _sql(
        f"SELECT id AS uuid, count_if({REFUSED}) = 0 AS complete, count_if({REFUSED}) AS missing_sentences, "
        f"CAST(count_if(NOT {REFUSED}) AS INTEGER) AS sentences FROM shards GROUP BY id", "shards",
    ),
    "x1_drain_payloads": _sql(
        "SELECT shard, pos, 'ok' AS status, array_to_string(list_transform(ids, lambda x: " + NEIGHBOUR + "), ' ') AS output_ids "
        "FROM encoded", "encoded",
    ),
    "x5_stream_tokens": _sql(
        f"SELECT t.id, sent_idx, {MEASURED.replace('sentence', 't.sentence')} AS input_ids FROM tagged t JOIN "
        "(SELECT shard, pos, sent_idx FROM shards) USING (shard, pos)", "tagged", "shards",
    ),
    "c1_prepare_bounded": _sql(
        f"SELECT shard, shard % {NODES} AS node, pos, pos // {TOKENIZE_BATCH} AS batch_id, id, {_text('ids', 'input_ids')} "
        "FROM prepared_top", "prepared_top",
    ),
    "s1_many_files": f'SELECT file_no, row_no AS "row", id, text FROM ({_docs(MANY_FILES)})',
    "j1_crowded_shard": _sql(
        "SELECT DISTINCT shard, island, islands.id AS uuid, CASE WHEN shard = 1 THEN 'later' ELSE dump END AS dump, url, file_path "
        "FROM islands JOIN docs USING (id)", "islands", "docs",
    ),
    "a7_observed_run": _sql(
        "SELECT 'translate' AS step, count(*) AS rows, count_if(status = 'ok') AS kept, count_if(status <> 'ok') AS set_aside, "
        "count(DISTINCT (shard, batch_id)) AS batches, count(DISTINCT (shard, batch_id)) FILTER (status = 'ok') AS kept_batches, "
        f"{CUT} AS truncated, CAST(NULL AS VARCHAR) AS error FROM {LABELLED_SENTENCES} UNION ALL "
        f"SELECT 'decode', count(*), count(*), 0, NULL, NULL, {CUT}, NULL FROM {LABELLED_SENTENCES} WHERE status = 'ok'",
        "labelled",
    ),
    "x3_resume": _sql(
        f"SELECT t.id, sent_idx, {MEASURED.replace('sentence', 't.sentence')} AS input_ids FROM tagged t JOIN "
        "(SELECT shard, pos, sent_idx FROM shards) USING (shard, pos)", "tagged", "shards",
    ),
    "x4_clean_source": _sql("SELECT shard, count(*) AS kept, count(*) AS drained FROM encoded GROUP BY shard", "encoded"),
    "f7_method": _sql("SELECT id, sent_idx, sentence FROM sent", "sent"),
    "c4_publish_and_retire": _sql(
        f"SELECT uuid, CASE WHEN shard % {NODES} <= 1 THEN 'published' ELSE 'kept' END AS state FROM pieces_out", "pieces_out"
    ),
}
