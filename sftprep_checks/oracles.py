"""DuckDB SQL oracles for the registered queries.

These restate each query independently in SQL over the same parquet views.
The chunkers are restated as recursive CTEs: one recursion step per chunk,
the separator search done by a greedy regular expression
(``(?s)^(.*)SEP`` captures everything before the *last* occurrence).
"""

from __future__ import annotations

import string as _string

from sftprep_checks import fixed as K
from sftprep_checks import fixtures as FX
from sftprep_checks import queries as _Q


def _rfind_rel(window: str, regex_sep: str) -> str:
    """0-based offset of the last occurrence of a separator inside ``window``;
    0 when absent (a hit at offset 0 can never pass the distance test)."""
    return f"length(regexp_extract({window}, '(?s)^(.*){regex_sep}', 1))"


# separator -> RE2 spelling inside a SQL literal (RE2 reads \n as newline)
_RE = {"\n\n": r"\n\n", "\n": r"\n", ". ": r"\. ", "? ": r"\? ", "! ": r"! ",
       "; ": r"; ", ", ": r", ", ": ": r": "}


def _re(sep: str) -> str:
    return _RE.get(sep, sep)


def plain_chunks_sql(table_sql: str, size: int, overlap: int, seps: list[str]) -> str:
    """Recursive CTE for C1 over ``table_sql`` (doc_id, text) -> doc_id, chunk_id, s, e, text."""
    reach = size // 4
    rs = ",\n".join(f"{_rfind_rel('w', _re(sep))} AS r{i}" for i, sep in enumerate(seps))
    whens = " ".join(
        f"WHEN r{i} > {reach} THEN s + r{i} + {len(sep)}" for i, sep in enumerate(seps)
    )
    end_of = f"""
      SELECT doc_id, chunk_id, s, text, n,
             CASE WHEN s + {size} >= n THEN n ELSE (CASE {whens} ELSE s + {size} END) END AS e
      FROM (SELECT *, {rs} FROM (SELECT *, substring(text, s + 1, {size}) AS w FROM {{src}}))"""
    return f"""
    WITH RECURSIVE d AS (
      SELECT doc_id, text, length(text)::BIGINT AS n FROM ({table_sql})
    ),
    c(doc_id, chunk_id, s, text, n, e) AS (
      SELECT doc_id, chunk_id, s, text, n,
             CASE WHEN n <= {size} THEN n ELSE e END
      FROM ({end_of.format(src="(SELECT doc_id, 0::BIGINT AS chunk_id, 0::BIGINT AS s, text, n FROM d)")})
      UNION ALL
      SELECT * FROM ({end_of.format(src=f'''(
          SELECT doc_id, chunk_id + 1 AS chunk_id,
                 CASE WHEN e - s <= {overlap} THEN e ELSE e - {overlap} END AS s, text, n
          FROM c
          WHERE n > {size} AND e - {overlap} < n
            AND (CASE WHEN e - s <= {overlap} THEN e ELSE e - {overlap} END) < n)''')})
    )
    SELECT doc_id, chunk_id, s, e, text FROM c"""


def chunk_text() -> str:
    inner = plain_chunks_sql(
        "SELECT doc_id, text FROM documents", FX.CHUNK_SIZE, FX.CHUNK_OVERLAP, K.PLAIN_SEPS
    )
    return f"""
    SELECT doc_id::BIGINT AS doc_id, chunk_id::BIGINT AS chunk_id,
           s::BIGINT AS chunk_start, e::BIGINT AS chunk_end,
           substring(text, s + 1, e - s) AS chunk
    FROM ({inner})"""


# ---------------------------------------------------------------- helpers


def lit(s: str) -> str:
    """SQL string literal (raw newlines are fine inside DuckDB literals)."""
    return "'" + s.replace("'", "''") + "'"


def fill_sql(template: str, values: dict[str, str]) -> str:
    parts = []
    for literal, field, _, _ in _string.Formatter().parse(template):
        if literal:
            parts.append(lit(literal))
        if field is not None:
            parts.append(f"coalesce(CAST({values[field]} AS VARCHAR), '')")
    return "(" + " || ".join(parts) + ")"


def source_id_sql(name: str) -> str:
    return f"replace(string_split({name}, '/')[-1], '.', '_')"


PLAIN = f"""({plain_chunks_sql("SELECT doc_id, text FROM documents", FX.CHUNK_SIZE, FX.CHUNK_OVERLAP, K.PLAIN_SEPS)})"""
CHUNKS = f"""(SELECT doc_id, chunk_id, s AS chunk_start, e AS chunk_end,
                     substring(text, s + 1, e - s) AS chunk FROM {PLAIN})"""


def chunk_text_defaults() -> str:
    inner = plain_chunks_sql("SELECT doc_id, text FROM documents", 1000, 100, K.PLAIN_SEPS)
    return f"""
    SELECT doc_id::BIGINT AS doc_id, chunk_id::BIGINT AS chunk_id,
           s::BIGINT AS chunk_start, e::BIGINT AS chunk_end,
           substring(text, s + 1, e - s) AS chunk
    FROM ({inner})"""


# ---------------------------------------------------------------- markdown
def markdown_docs_sql() -> str:
    inj = lit(_Q.INJECTED)
    return f"""
    SELECT doc_id, CASE WHEN lang = {lit(_Q.INJECT_LANG)}
        THEN substring(text, 1, length(text) // 2) || {inj} || substring(text, length(text) // 2 + 1)
        ELSE text END AS text
    FROM documents"""


def markdown_chunks_sql(docs_sql: str, size: int, overlap: int) -> str:
    half = size // 2
    nl = "chr(10)"
    step = f"""
      SELECT doc_id, chunk_id, s, text, n, starts, tbls, tend, last_fence, nl,
        CASE WHEN e1 >= n THEN e1
             WHEN r_pp > {half} THEN s + r_pp + 2
             WHEN r_nl > {half} THEN s + r_nl + 1
             WHEN r_se > {half} THEN s + r_se + 2
             WHEN r_ot > {half} THEN s + r_ot + 2
             ELSE e1 END AS e
      FROM (
        SELECT *,
          {_rfind_rel('w', r'\n\n')} AS r_pp,
          {_rfind_rel('w', r'\n')} AS r_nl,
          {_rfind_rel('w', r'\.[ \n]')} AS r_se,
          {_rfind_rel('w', r'[.?!:;] ')} AS r_ot
        FROM (
          SELECT *, CASE WHEN e1 < n THEN substring(text, s + 1, e1 - s) ELSE '' END AS w
          FROM (
            SELECT *,
              CASE
                WHEN tbls[li] OR (li > 1 AND tbls[li - 1]) OR (li < nl AND tbls[li + 1])
                  THEN greatest(e0, tend[li])
                WHEN last_fence IS NOT NULL AND last_fence <= li
                  THEN greatest(e0, CASE WHEN last_fence = li AND li < nl THEN starts[li + 1] ELSE n END)
                ELSE e0 END AS e1
            FROM (
              SELECT *, len(list_filter(starts, lambda x: x <= e0)) AS li
              FROM (SELECT *, least(s + {size}, n) AS e0 FROM {{src}})
            )
          )
        )
      )"""
    return f"""
    WITH RECURSIVE d AS (
      SELECT doc_id, text, length(text)::BIGINT AS n, string_split(text, {nl}) AS parts FROM ({docs_sql})
    ),
    lines AS (
      SELECT doc_id, n, i, line,
             (sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) - (length(line) + 1))::BIGINT AS st,
             (contains(line, '|') OR regexp_matches(line, '^\\s*\\+-')) AS tbl,
             regexp_matches(line, '^\\s*```') AS fence
      FROM (SELECT doc_id, n, generate_subscripts(parts, 1) AS i, unnest(parts) AS line FROM d)
    ),
    lines2 AS (
      SELECT *, coalesce(min(CASE WHEN NOT tbl THEN st END) OVER (
                  PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), n) AS te
      FROM lines
    ),
    lay AS (
      SELECT doc_id, list(st ORDER BY i) AS starts, list(tbl ORDER BY i) AS tbls,
             list(te ORDER BY i) AS tend, max(i) FILTER (WHERE fence) AS last_fence, count(*) AS nl
      FROM lines2 GROUP BY doc_id
    ),
    dl AS (SELECT d.doc_id, d.text, d.n, lay.* EXCLUDE (doc_id) FROM d JOIN lay USING (doc_id)),
    c AS (
      {step.format(src="(SELECT doc_id, 0::BIGINT AS chunk_id, 0::BIGINT AS s, text, n, starts, tbls, tend, last_fence, nl FROM dl)")}
      UNION ALL
      {step.format(src=f'''(
          SELECT doc_id, chunk_id + 1 AS chunk_id,
                 CASE WHEN e - s <= {overlap} THEN e ELSE e - {overlap} END AS s,
                 text, n, starts, tbls, tend, last_fence, nl
          FROM c
          WHERE n > {size} AND e - {overlap} < n
            AND (CASE WHEN e - s <= {overlap} THEN e ELSE e - {overlap} END) < n)''')}
    )
    SELECT doc_id, chunk_id, s, CASE WHEN n <= {size} THEN n ELSE e END AS e, text FROM c"""


def chunk_markdown() -> str:
    inner = markdown_chunks_sql(markdown_docs_sql(), FX.MD_CHUNK_SIZE, FX.MD_OVERLAP)
    return f"""
    SELECT doc_id::BIGINT AS doc_id, chunk_id::BIGINT AS chunk_id,
           s::BIGINT AS chunk_start, e::BIGINT AS chunk_end,
           substring(text, s + 1, e - s) AS chunk
    FROM ({inner})"""


# ---------------------------------------------------------------- sources
FILE_NAMES = """(
  SELECT doc_id, CASE WHEN source = 'src3' THEN 'doc' || doc_id
    ELSE 'doc.' || doc_id || '.' || CASE lang WHEN 'en' THEN 'txt' WHEN 'fr' THEN 'PDF'
                                          WHEN 'de' THEN 'html' ELSE 'Md' END END AS name
  FROM documents)"""


def doc_filter() -> str:
    exts = ", ".join(lit(e) for e in ("docx", "pdf", "txt", "md", "xlsx", "csv", "pptx"))
    return f"""
    SELECT doc_id::BIGINT AS doc_id, name, lower(string_split(name, '.')[-1]) AS ext,
           {source_id_sql('name')} AS source
    FROM {FILE_NAMES}
    WHERE lower(string_split(name, '.')[-1]) IN ({exts})"""


# ---------------------------------------------------------------- prompts
def question_prompts() -> str:
    p = fill_sql(K.QUESTION_PROMPT, {"context": "chunk", "target_num": str(FX.GENERATE_NUM)})
    return f"SELECT doc_id::BIGINT AS doc_id, chunk_id::BIGINT AS chunk_id, {p} AS prompt FROM {CHUNKS}"


STUB_Q = """('What does ' || md5(chunk) || ' cover?,Which points fill ' || length(chunk) || ' characters?'
           || CASE WHEN contains(chunk, ',') THEN ',Why the commas?' ELSE '' END
           || CASE WHEN length(chunk) % 7 = 0 THEN ',' ELSE '' END)"""
STUB_A = "('<reference>' || md5(chunk) || '</reference><answer>' || question || '</answer>')"


def _split_sql(keys: str, text: str, src: str) -> str:
    return f"""(SELECT {keys}, generate_subscripts(parts, 1) - 1 AS question_no, unnest(parts) AS question
               FROM (SELECT {keys}, string_split({text}, ',') AS parts FROM {src}))"""


QUESTIONS = _split_sql("doc_id, chunk_id, chunk", STUB_Q, CHUNKS)


def answer_prompts() -> str:
    p = fill_sql(K.ANSWER_PROMPT, {"context": "chunk", "question": "question"})
    return f"""SELECT doc_id::BIGINT AS doc_id, chunk_id::BIGINT AS chunk_id,
                      question_no::BIGINT AS question_no, question, {p} AS prompt FROM {QUESTIONS}"""


def parse_questions() -> str:
    src = "(SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant')"
    return f"""SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, question_no::BIGINT AS question_no,
                      question FROM {_split_sql('conv_id, turn', 'text', src)}"""


# ---------------------------------------------------------------- resume / pairs
def resume_skip() -> str:
    return f"""
    WITH ch AS (SELECT 'doc_' || doc_id || '_txt' AS source, chunk_id, chunk_start, chunk_end FROM {CHUNKS}),
    ex AS (SELECT 'doc_' || conv_id || '_txt' AS source, turn // 2 AS chunk_id FROM conversations),
    done AS (SELECT source, chunk_id FROM ex GROUP BY ALL HAVING count(*) >= {FX.GENERATE_NUM})
    SELECT source, chunk_id::BIGINT AS chunk_id, chunk_start::BIGINT AS chunk_start,
           chunk_end::BIGINT AS chunk_end
    FROM ch WHERE NOT EXISTS (SELECT 1 FROM done WHERE done.source = ch.source AND done.chunk_id = ch.chunk_id)"""


QA_PAIRS = """(
  SELECT u.text AS question, a.text AS answer, 'conv_' || u.conv_id AS source,
         u.turn::BIGINT AS chunk_id, u.text AS chunk
  FROM conversations u JOIN conversations a
    ON md5(concat_ws(chr(31), u.conv_id, u.turn)) = md5(concat_ws(chr(31), a.conv_id, a.turn - 1))
  WHERE u.role = 'user' AND a.role = 'assistant')"""


def qa_pairs() -> str:
    return f"SELECT * FROM {QA_PAIRS}"


def merge_pairs() -> str:
    return f"""SELECT * FROM {QA_PAIRS} WHERE chunk_id < 2
               UNION ALL SELECT * FROM {QA_PAIRS} WHERE chunk_id >= 2 AND chunk_id < 4
               UNION ALL SELECT * FROM {QA_PAIRS} WHERE chunk_id >= 4"""


def alpaca_records() -> str:
    return f"SELECT question AS instruction, '' AS input, answer AS output FROM {QA_PAIRS}"


# ---------------------------------------------------------------- records / chat
def merged_prompt() -> str:
    return f"""
    SELECT d.doc_id::BIGINT AS doc_id,
           d.text || CASE WHEN l.quality IS NULL THEN ''
                          ELSE {lit(chr(10) + 'Your input is:' + chr(10))} || 'quality=' || l.quality || ' toxic=' || l.toxic
                     END AS merged
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


MSGS = f"""(
  SELECT source, chunk_id, 0 AS msg_no, 'human' AS from_, 'user' AS role, question AS value FROM {QA_PAIRS}
  UNION ALL
  SELECT source, chunk_id, 1, 'gpt', 'assistant', answer FROM {QA_PAIRS})"""


def sharegpt() -> str:
    return f"SELECT source, chunk_id::BIGINT AS chunk_id, msg_no::BIGINT AS msg_no, from_, value FROM {MSGS}"


def normalized_roles() -> str:
    return f"""SELECT source, chunk_id::BIGINT AS chunk_id, msg_no::BIGINT AS msg_no, role,
                      value AS content FROM {MSGS}"""


def _render_pair(system: str) -> str:
    return (f"{lit(system + K.TURN_GLUE + K.INSTRUCTION_HEAD)} || question || "
            f"{lit(K.TURN_GLUE + K.RESPONSE_HEAD)} || answer")


def chat_text() -> str:
    return f"SELECT source, chunk_id, {_render_pair(K.PREAMBLE)} AS text FROM {QA_PAIRS}"


def chat_text_system() -> str:
    return f"SELECT source, chunk_id, {_render_pair(_Q.SYSTEM_PROMPT)} AS text FROM {QA_PAIRS}"


def conversation_messages() -> str:
    return """
    SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_messages,
           string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS transcript
    FROM conversations GROUP BY conv_id"""


def role_quarantine() -> str:
    return """
    SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, r AS role, 'Invalid role: ' || r AS error
    FROM (SELECT conv_id, turn, CASE WHEN role = 'system' THEN 'tool' ELSE role END AS r FROM conversations)
    WHERE r NOT IN ('system', 'user', 'assistant')"""


def extend_conversations() -> str:
    k, seed = FX.EXTENSION_K, FX.EXTENSION_SEED
    rec = f"""(SELECT source || ':' || chunk_id AS rec_id, question AS t0, answer AS t1 FROM {QA_PAIRS})"""
    copies = []
    joins = []
    for i in range(1, k):
        copies.append(f"""p{i} AS (SELECT rec_id AS id{i}, t0 AS a{i}, t1 AS b{i},
            row_number() OVER (ORDER BY md5('{seed + i}:' || rec_id), rec_id) - 1 AS pos FROM rec)""")
        joins.append(f"JOIN p{i} ON p{i}.pos = base.pos")
    turns = ["base.t0", "base.t1"] + [x for i in range(1, k) for x in (f"a{i}", f"b{i}")]
    return f"""
    WITH rec AS {rec},
    base AS (SELECT *, row_number() OVER (ORDER BY rec_id) - 1 AS pos FROM rec),
    {", ".join(copies)}
    SELECT base.rec_id, {2 * k}::BIGINT AS n_turns, concat_ws(chr(30), {", ".join(turns)}) AS joined
    FROM base {" ".join(joins)}"""


# ---------------------------------------------------------------- calibration
SAMPLE = f"""(SELECT conv_id FROM (SELECT DISTINCT conv_id FROM conversations)
              ORDER BY md5('{FX.CALIBRATION_SEED}:' || conv_id), conv_id LIMIT {FX.CALIBRATION_N})"""


def calibration_sample() -> str:
    return f"SELECT conv_id::BIGINT AS conv_id FROM {SAMPLE}"


CAL_TEXT = f"""(
  SELECT conv_id,
    coalesce(arg_min(text, turn) FILTER (WHERE role = 'system'), {lit(K.PREAMBLE)}) || {lit(K.TURN_GLUE)} ||
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN {lit(K.RESPONSE_HEAD)} ELSE {lit(K.INSTRUCTION_HEAD)} END
                        || text, {lit(K.TURN_GLUE)} ORDER BY turn) FILTER (WHERE role <> 'system'), '') AS text
  FROM conversations WHERE conv_id IN {SAMPLE} GROUP BY conv_id)"""


def calibration_text() -> str:
    return f"SELECT conv_id::BIGINT AS conv_id, text FROM {CAL_TEXT}"


def calibration_tokens() -> str:
    n = FX.CALIBRATION_MAX_TOKENS
    return f"""
    SELECT conv_id::BIGINT AS conv_id, len(toks)::BIGINT AS n_tokens, array_to_string(toks, ' ') AS tokens
    FROM (SELECT conv_id,
                 list_slice(list_filter(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+'), lambda t: t <> ''), 1, {n})
                   AS toks
          FROM {CAL_TEXT})"""


# ---------------------------------------------------------------- images
IMAGES = """(
  SELECT page_id, 'p' || page_id || '.png' AS rel_path, 'images/p' || page_id || '.png' AS image_path,
         regexp_extract(url, '\\.example\\.([a-z]+)', 1) AS tld, octet_length(encode(html)) AS html_bytes
  FROM pages)"""
MANIFEST = """(
  SELECT doc_id, 'p' || (doc_id // 3) || '.png' AS file_name,
         CASE WHEN lang = 'en' THEN 'What is on page ' || (doc_id // 3) || '?' END AS instruction, text
  FROM documents)"""
MAGIC_LEN = {k: len(v) // 2 for k, v in _Q.IMAGE_MAGIC.items()}
JOINED = f"""(
  SELECT m.doc_id, m.file_name, m.instruction, m.text, i.image_path, i.tld,
         i.html_bytes + CASE i.tld {" ".join(f"WHEN '{k}' THEN {v}" for k, v in MAGIC_LEN.items())} END AS n_bytes,
         CASE i.tld WHEN 'com' THEN 'png' WHEN 'net' THEN 'jpeg' END AS image_format
  FROM {MANIFEST} m JOIN {IMAGES} i ON m.file_name = i.rel_path)"""
VALID = f"(SELECT * FROM {JOINED} WHERE image_format IS NOT NULL)"


def images_joined() -> str:
    return f"SELECT doc_id::BIGINT AS doc_id, file_name, image_path, n_bytes::BIGINT AS n_bytes, text FROM {JOINED}"


def images_valid() -> str:
    return f"""SELECT doc_id::BIGINT AS doc_id, file_name, image_path, image_format,
                      n_bytes::BIGINT AS n_bytes FROM {VALID}"""


def vlm_conversation() -> str:
    return f"""
    SELECT doc_id::BIGINT AS doc_id, 0::BIGINT AS msg_no, 'user' AS role, 0::BIGINT AS part_no,
           'text' AS type, instruction AS text, NULL::VARCHAR AS image_path FROM {VALID}
    UNION ALL
    SELECT doc_id, 0, 'user', 1, 'image', NULL, image_path FROM {VALID}
    UNION ALL
    SELECT doc_id, 1, 'assistant', 0, 'text', text, NULL FROM {VALID}"""


def vlm_messages() -> str:
    instr = f"coalesce(instruction, {lit(K.DEFAULT_VLM_INSTRUCTION)})"
    return f"""
    SELECT doc_id::BIGINT AS doc_id, 0::BIGINT AS msg_no, 'system' AS role, 0::BIGINT AS part_no,
           'text' AS type, {lit(_Q.VLM_SYSTEM)} AS text, NULL::VARCHAR AS url FROM {VALID}
    UNION ALL SELECT doc_id, 1, 'user', 0, 'image', NULL, image_path FROM {VALID}
    UNION ALL SELECT doc_id, 1, 'user', 1, 'text', {instr}, NULL FROM {VALID}
    UNION ALL SELECT doc_id, 2, 'assistant', 0, 'text', text, NULL FROM {VALID}"""


def vendor_qa() -> str:
    return f"""SELECT instruction AS question, text AS answer, image_path, n_bytes::BIGINT AS n_bytes
               FROM {JOINED} WHERE instruction IS NOT NULL AND text IS NOT NULL"""


def keyed_qa() -> str:
    return f"""SELECT {lit(K.VENDOR_SYSTEM_PROMPT)} AS system, instruction AS "user", text AS assistant,
                      image_path
               FROM {JOINED} WHERE instruction IS NOT NULL AND text IS NOT NULL"""


# ---------------------------------------------------------------- shards
def shard_assign() -> str:
    n = FX.SHARDS
    return f"""
    SELECT doc_id::BIGINT AS doc_id, rn::BIGINT AS row_idx,
           (rn // ((cnt + {n} - 1) // {n}))::BIGINT AS shard
    FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS rn, count(*) OVER () AS cnt FROM documents)"""


def shard_manifest() -> str:
    n = FX.SHARDS
    return f"""
    WITH c AS (SELECT count(*) AS cnt FROM documents),
    s AS (SELECT range AS shard FROM range({n}))
    SELECT s.shard::BIGINT AS shard,
           'train-' || lpad(s.shard::VARCHAR, 5, '0') || '-of-' || lpad('{n}', 5, '0') || '.parquet' AS file_name,
           greatest(0, least((s.shard + 1) * ((c.cnt + {n} - 1) // {n}), c.cnt)
                       - s.shard * ((c.cnt + {n} - 1) // {n}))::BIGINT AS n_rows
    FROM s, c"""


# ---------------------------------------------------------------- streaming / flagship
def incremental_chunks() -> str:
    return chunk_text()


def qa_generation() -> str:
    named = f"(SELECT 'doc_' || doc_id || '_txt' AS source, chunk_id, chunk FROM {CHUNKS})"
    qs = _split_sql("source, chunk_id, chunk", STUB_Q, named)
    return f"""
    SELECT source, chunk_id::BIGINT AS chunk_id, question_no::BIGINT AS question_no, question,
           {STUB_A} AS answer, chunk
    FROM {qs}"""


# ---------------------------------------------------------------- more coverage
def training_json() -> str:
    return f"""SELECT source, chunk_id, json_object('instruction', question, 'input', '', 'output', answer)::VARCHAR
                      AS record FROM {QA_PAIRS}"""


def chat_dataset() -> str:
    seed = FX.EXTENSION_SEED + 1
    ih, rh, g = K.INSTRUCTION_HEAD, K.RESPONSE_HEAD, K.TURN_GLUE
    return f"""
    WITH rec AS (SELECT source || ':' || chunk_id AS rec_id, question AS q, answer AS a FROM {QA_PAIRS}),
    base AS (SELECT *, row_number() OVER (ORDER BY rec_id) - 1 AS pos FROM rec),
    p1 AS (SELECT q AS q1, a AS a1, row_number() OVER (ORDER BY md5('{seed}:' || rec_id), rec_id) - 1 AS pos FROM rec)
    SELECT rec_id, 4::BIGINT AS n_messages,
           {lit(_Q.SYSTEM_PROMPT + g + ih)} || q || {lit(g + rh)} || a || {lit(g + ih)} || q1 || {lit(g + rh)} || a1
             AS text
    FROM base JOIN p1 USING (pos)"""


def source_collisions_report() -> str:
    return """
    SELECT source, count(DISTINCT name)::BIGINT AS n_names FROM (
      SELECT name, replace(name, '.', '_') AS source FROM (
        SELECT 'doc.' || doc_id || '.txt' AS name FROM documents
        UNION ALL SELECT 'doc_' || doc_id || '.txt' FROM documents WHERE lang = 'fr'))
    GROUP BY source HAVING count(DISTINCT name) > 1"""


def image_quarantine() -> str:
    return f"""SELECT doc_id::BIGINT AS doc_id, file_name, image_path, n_bytes::BIGINT AS n_bytes
               FROM {JOINED} WHERE image_format IS NULL"""


def keyed_qa_inference() -> str:
    return f"""SELECT {lit(K.VENDOR_SYSTEM_PROMPT)} AS system, instruction AS "user", text AS label, image_path
               FROM {JOINED} WHERE instruction IS NOT NULL AND text IS NOT NULL"""


def qa_generation_resumed() -> str:
    k = FX.GENERATE_NUM
    return f"""
    WITH ch AS (SELECT 'doc_' || doc_id || '_txt' AS source, chunk_id, chunk FROM {CHUNKS}),
    ex AS (SELECT 'doc_' || conv_id || '_txt' AS source, turn // 2 AS chunk_id, count(*) AS n
           FROM conversations GROUP BY ALL),
    new AS (SELECT ch.source, ch.chunk_id, len(string_split({STUB_Q}, ',')) AS n
            FROM ch LEFT JOIN ex ON ex.source = ch.source AND ex.chunk_id = ch.chunk_id
            WHERE coalesce(ex.n, 0) < {k})
    SELECT source, chunk_id::BIGINT AS chunk_id, sum(n)::BIGINT AS n_pairs
    FROM (SELECT * FROM ex UNION ALL SELECT * FROM new) GROUP BY ALL"""


def qa_generation_restarted() -> str:
    return f"SELECT question, answer, source, chunk_id, chunk FROM ({qa_generation()})"


def images_present() -> str:
    return f"""SELECT doc_id::BIGINT AS doc_id, file_name FROM {MANIFEST} m
               WHERE EXISTS (SELECT 1 FROM {IMAGES} i WHERE i.rel_path = m.file_name)"""


def qa_generation_offline() -> str:
    named = f"(SELECT 'doc_' || doc_id || '_txt' AS source, chunk_id, chunk FROM {CHUNKS})"
    qs = _split_sql("source, chunk_id, chunk", STUB_Q, named)
    return f"""
    SELECT source, chunk_id::BIGINT AS chunk_id, question, {STUB_A} AS answer, chunk FROM {qs}"""


# ---------------------------------------------------------------- written and read back
def pairs_sink_roundtrip() -> str:
    return """SELECT 'q' || doc_id AS question, substring(text, 1, 40) AS answer, source,
                     doc_id::BIGINT AS chunk_id, text AS chunk FROM documents"""


def sharded_sink_roundtrip() -> str:
    n = FX.SHARDS
    return f"""
    SELECT doc_id, _label, n_chars,
           'train-' || lpad(CAST(rn // size AS VARCHAR), 5, '0') || '-of-{n:05d}.parquet' AS shard_file
    FROM (SELECT doc_id, lang AS _label, n_chars, row_number() OVER (ORDER BY doc_id) - 1 AS rn,
                 CAST(ceil(count(*) OVER () / {n}.0) AS BIGINT) AS size FROM documents)"""


def document_files() -> str:
    return """
    SELECT name, lower(ext) AS ext, replace(name, '.', '_') AS source, text
    FROM (SELECT CASE doc_id % 5 WHEN 1 THEN '_' WHEN 2 THEN '.' ELSE '' END || 'd' || doc_id || '.' || ext AS name, ext, text
          FROM (SELECT *, CASE lang WHEN 'en' THEN 'txt' WHEN 'fr' THEN 'MD' WHEN 'de' THEN 'html' ELSE 'csv' END AS ext FROM documents))
    WHERE ext <> 'html'"""


def image_files_roundtrip() -> str:
    return """SELECT source || '/' || CASE doc_id % 7 WHEN 1 THEN '_' WHEN 2 THEN '.' ELSE '' END || doc_id || '.png' AS name,
                     lang AS text, CASE lang WHEN 'de' THEN 28 ELSE 8 END + octet_length(encode(text)) AS n_bytes
              FROM documents WHERE lang <> 'fr'"""


def training_json_roundtrip() -> str:
    return "SELECT lang AS instruction, source AS input, text AS output FROM documents"


def training_json_array() -> str:
    return "SELECT lang AS instruction, source AS input, text AS output, doc_id, n_chars::BIGINT AS n_chars FROM documents"


def load_chunks_of_files() -> str:
    inner = plain_chunks_sql("SELECT 'd' || doc_id || '_txt' AS doc_id, text FROM documents", FX.CHUNK_SIZE, FX.CHUNK_OVERLAP, K.PLAIN_SEPS)
    return f"""
    SELECT doc_id AS source, chunk_id::BIGINT AS chunk_id, s::BIGINT AS chunk_start, e::BIGINT AS chunk_end,
           substring(text, s + 1, e - s) AS chunk
    FROM ({inner})"""


def manifest_roundtrip() -> str:
    return "SELECT source || '/' || doc_id AS file_name, lang AS instruction, text FROM documents"


ALL_TEXT = CAL_TEXT.replace(f"WHERE conv_id IN {SAMPLE} ", "")


def render_all_conversations() -> str:
    return f"SELECT conv_id, text FROM {ALL_TEXT}"


def tokenize_all_conversations() -> str:
    return calibration_tokens().replace(CAL_TEXT, ALL_TEXT)


def vlm_from_table() -> str:
    return f"""SELECT doc_id, instruction, image_path, n_bytes::BIGINT AS n_bytes, text AS answer FROM {VALID}"""


def calibration_messages_array() -> str:
    return f"SELECT n_tokens, tokens FROM ({calibration_tokens()})"


def incremental_documents() -> str:
    inner = plain_chunks_sql(
        "SELECT CASE WHEN doc_id % 5 IN (1, 2) THEN '_' ELSE '' END || 'd_' || doc_id || CASE lang WHEN 'en' THEN '_txt' ELSE '_MD' END AS doc_id, text FROM documents",
        FX.CHUNK_SIZE, FX.CHUNK_OVERLAP, K.PLAIN_SEPS,
    )
    return f"""
    SELECT doc_id AS source, chunk_id::BIGINT AS chunk_id, s::BIGINT AS chunk_start, e::BIGINT AS chunk_end,
           substring(text, s + 1, e - s) AS chunk
    FROM ({inner})"""
