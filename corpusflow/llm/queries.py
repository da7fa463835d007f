"""Registered queries of the training-data operators and their oracle SQL.

Each query applies one operator with production parameters to its whole
table and derives the digest columns from the operator's output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, collocations, ctw, frames, licences, linecrf, merkle, nndescent, packing, sharding, simhash, suffix, tokens
from .common import lower_ascii, table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text with the multilingual ranks and decode the ids."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, ranks, public_tokenizers.PATTERN).select("doc_id", "ids")
    out = bpe.decode(ids, ranks, public_tokenizers.PATTERN)
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


PROBE = "</s>[INST] ok [/INST]"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix-target expansion of every conversation plus conversation -7,
    read back from the formatted examples."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    back = chat.read_back(chat.expand(turns.unionByName(probe)))
    said = F.concat_ws("", F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"))


def _sql_escape(col: str) -> str:
    out = f"replace({col}, '&', '&amp;')"
    for s in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"):
        out = f"replace({out}, '{s}', '{'&lt;' if s[0] == '<' else '&#91;'}{s[1:]}')"
    return out


OP2_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
r AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
         sum(length({_sql_escape('role')}) + length({_sql_escape('text')}) + 23) OVER
           (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS upto
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(upto) FILTER (role = 'assistant' OR i = n))::BIGINT AS formatted_chars
FROM r GROUP BY conv_id
"""


#: Id 2 ends every document of the packed corpus.
PACK_END = bytes([2, 0, 0, 0])


def packed_pieces(docs: DataFrame) -> DataFrame:
    """Token ids with the end id, cut into pieces of at most 1024."""
    ids = tokens.tokenize(docs, public_tokenizers.path("byte_bpe_50k.json"))
    ids = ids.withColumn("ids", F.concat("ids", F.lit(PACK_END)))
    return packing.cut(ids.drop("text"))


def op3_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best-fit packing of all documents into sequences of 1024 tokens."""
    pieces = packed_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"))
    placed = packing.pack(pieces.select("doc_id", "piece", "start", "length", "ids"))
    return placed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op4_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 24 shards of near-equal bytes by histogram sort."""
    text = F.coalesce("text", F.lit(""))
    size = (F.octet_length(text) + 8).cast("long")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = sharding.shard(docs, 24, size, F.xxhash64("text"), F.col("doc_id"), ["doc_id", "text"])
    return out.select("doc_id", size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op5_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context-tree weighting scores of all documents."""
    out = ctw.score(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
                      (-F.col("score") * F.log2(F.lit(10.0)) / F.col("n_bytes")).alias("bits_per_byte"))


def op6_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and the line field's verdict for all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = linecrf.fit(docs, table(spark, sf_dir, "labels"))
    m = F.col("measures")
    out = linecrf.measure(docs, model)
    return out.select("doc_id", *[m[c].alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        linecrf.base_failed(m).alias("base_failed"), linecrf.kept(m).alias("kept"),
        m["content_share"].alias("content_share"))


def op7_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files of all documents, written and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = tokens.tokenize(docs, public_tokenizers.path("word_bpe_49k.json"))
    ids = ids.select("doc_id", F.concat("ids", F.lit(bytes([1, 0, 0, 0]))).alias("ids"))
    return frames.read(frames.write(ids), digest=True)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 100-byte strings removed from all documents."""
    out = suffix.drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["at"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest vectors of every row whose id is divisible by 50."""
    rows = table(spark, sf_dir, "embeddings")
    index = nndescent.build(rows)
    return nndescent.search(index, rows.filter(F.col("vec_id") % 50 == 0).select("vec_id"))


def op10_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate components of all documents."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op11_rare_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates in all documents."""
    out = licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), out="licence")
    base, found = F.col("licence.base"), F.col("licence.found")
    at = F.flatten(base["places"])
    fixed = F.transform(F.filter(base, lambda b: F.size(b["places"]) > 0), lambda b: b["label"])
    return out.select(
        "doc_id", "licence.n_words", F.size(at).cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"), F.array_max(at).cast("long").alias("last_word"),
        licences.labels(fixed).alias("base_labels"), licences.labels(F.concat(fixed, found["label"])).alias("labels"),
        F.coalesce(F.array_max(found["score"]), F.lit(0.0)).alias("score"),
        F.array_join(found["name"], ",").alias("templates"))


def _sql_licences() -> str:
    """The licence scan as joins: postings of templates and files, votes per
    (file, template, cell), phrases as equal list slices."""
    def text(s):
        return "'" + s.replace("'", "''") + "'"
    low, fold = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')", r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    named = ", ".join(f"({text(t.name)}, {text(t.label)}, {text(t.text)}, {i})" for i, t in enumerate(licences.TEMPLATES))
    phrases = ", ".join(f"({text(t.name)}, {k}, {text(p)})" for t in licences.TEMPLATES for k, p in enumerate(t.phrases))
    base = ", ".join(f"({text(p)}, {text(label)})" for p, label in licences.BASE)
    cells = "[CAST(floor({0} / 16.0) AS INTEGER) * 2, CAST(floor(({0} + 8) / 16.0) AS INTEGER) * 2 + 1]"
    return f"""
WITH t AS (SELECT name, label, ord, regexp_extract_all({low}, {fold}) AS ws FROM (VALUES {named}) v(name, label, text, ord)),
p AS (SELECT name, k, regexp_extract_all({low}, {fold}) AS ps FROM (VALUES {phrases}) v(name, k, text)),
b AS (SELECT string_split(text, ' ') AS ps, label FROM (VALUES {base}) v(text, label)),
q AS (SELECT name, ws[i + 1] AS w, CAST(i AS INTEGER) AS q FROM t, range(0, 100) r(i) WHERE i < len(ws)),
h AS (SELECT p.*, (SELECT min(i) FROM range(0, 100) r(i) WHERE t.ws[(i + 1):(i + len(ps))] = ps) AS home FROM p JOIN t USING (name)),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({low}, {fold}) AS ws FROM documents),
u AS (SELECT r, CAST(unnest(range(0, len(ws))) AS INTEGER) AS i, unnest(ws) AS w FROM d),
v AS (SELECT DISTINCT w FROM q UNION SELECT unnest(ps) FROM b),
f AS (SELECT w, count(DISTINCT r) AS df FROM u SEMI JOIN v USING (w) GROUP BY w),
g AS (SELECT v.w, greatest(1, CAST(round(1000 * ln(((SELECT count(*) FROM d) + 1) / (coalesce(df, 0) + 1))) AS BIGINT)) AS weight
  FROM v LEFT JOIN f USING (w)),
x AS (SELECT DISTINCT r, w FROM u SEMI JOIN v USING (w)),
n AS (SELECT name, list_distinct(flatten(list(ps))) AS need FROM p GROUP BY name),
a AS (SELECT r, name FROM x JOIN (SELECT name, unnest(need) AS w, len(need) AS n FROM n) USING (w) GROUP BY r, name, n HAVING count(*) = n),
y AS (SELECT a.r, a.name, x.w, weight FROM a JOIN x USING (r) JOIN (SELECT DISTINCT name, w FROM q) q ON q.name = a.name AND q.w = x.w JOIN g ON g.w = x.w),
z AS (SELECT *, row_number() OVER (PARTITION BY r, name ORDER BY weight DESC, w) AS k, count(*) OVER (PARTITION BY r, name) AS present FROM y),
c AS (SELECT DISTINCT y.r, y.name, y.w, unnest({cells.format('(u.i - q.q)')}) AS cell FROM y JOIN u ON u.r = y.r AND u.w = y.w
  JOIN q ON q.name = y.name AND q.w = y.w),
s AS (SELECT c.r, c.name, cell FROM c JOIN z ON z.r = c.r AND z.name = c.name AND z.w = c.w AND z.k <= {licences.PROBES}
  GROUP BY c.r, c.name, cell, present HAVING 2 * count(*) >= least(present, {licences.PROBES})),
o AS (SELECT DISTINCT a.r, a.name, h.k, unnest({cells.format('(u.i - h.home)')}) AS cell FROM a JOIN h ON h.name = a.name
  JOIN u ON u.r = a.r AND u.w = h.ps[1] JOIN d ON d.r = a.r WHERE d.ws[(u.i + 1):(u.i + len(h.ps))] = h.ps),
e AS (SELECT s.r, s.name, s.cell FROM s JOIN o ON o.r = s.r AND o.name = s.name AND o.cell = s.cell
  GROUP BY s.r, s.name, s.cell HAVING count(*) = (SELECT count(*) FROM p WHERE p.name = s.name)),
m AS (SELECT e.r, e.name, e.cell, sum(weight) AS got FROM e JOIN c ON c.r = e.r AND c.name = e.name AND c.cell = e.cell
  JOIN g ON g.w = c.w GROUP BY e.r, e.name, e.cell),
k AS (SELECT r, m.name, CAST(max(got) AS DOUBLE) / (SELECT sum(weight) FROM g WHERE w IN (SELECT w FROM q WHERE q.name = m.name)) AS score
  FROM m GROUP BY r, m.name),
l AS (SELECT k.r, max(score) AS score, list(DISTINCT label) AS labels, string_agg(t.name, ',' ORDER BY ord) AS templates
  FROM k JOIN t ON t.name = k.name WHERE score >= {licences.SHARE} GROUP BY k.r),
j AS (SELECT u.r, label, count(*) AS n, min(u.i) AS lo, max(u.i) AS hi FROM u JOIN b ON b.ps[1] = u.w JOIN d ON d.r = u.r
  WHERE d.ws[(u.i + 1):(u.i + len(b.ps))] = b.ps GROUP BY u.r, label),
i AS (SELECT r, CAST(sum(n) AS BIGINT) AS n, min(lo) AS lo, max(hi) AS hi, list(DISTINCT label) AS labels FROM j GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(i.n, 0) AS n_base, CAST(i.lo AS BIGINT) AS first_word,
  CAST(i.hi AS BIGINT) AS last_word, coalesce(array_to_string(list_sort(i.labels), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(i.labels, []), coalesce(l.labels, [])))), ',') AS labels,
  coalesce(l.score, 0.0) AS score, coalesce(l.templates, '') AS templates
FROM d LEFT JOIN i ON i.r = d.r LEFT JOIN l ON l.r = d.r
"""


OP11_SQL = _sql_licences()


def op12_merkle_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and proofs of all documents; a third of them tampered."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")

    def values(text):
        return [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")] + [text]
    drawn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    bad = F.when(drawn, merkle.leaf(*values(lower_ascii(F.col("text")))))
    out = merkle.manifest(docs, F.col("doc_id"), F.col("lang"), values(F.col("text")), bad)
    back = merkle.folded(F.coalesce("load", "leaf"), F.col("path"))
    return (out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                       merkle.proof(F.col("path")).alias("proof_sha256"), back.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def _sql_tree(leaves: str, name: str, levels: int) -> str:
    """CTEs of a tree over ``leaves(g, i, d)``: per level ``k`` the nodes
    ``{name}{k}(g, i, d, n)`` and what stands beside each, ``{name}s{k}``."""
    out = [f"{name}0 AS (SELECT g, i, d, count(*) OVER (PARTITION BY g) AS n FROM {leaves})"]
    for k in range(levels):
        out.append(f"""{name}p{k} AS (SELECT g, i // 8 AS j, any_value(n) AS n, list(d ORDER BY i) AS ds FROM {name}{k} GROUP BY ALL)""")
        out.append(f"""{name}s{k} AS (SELECT c.g, c.i,
  CASE WHEN c.n = 1 THEN '' ELSE array_to_string(ds[:(c.i % 8)], '') END AS l,
  CASE WHEN c.n = 1 THEN '' ELSE array_to_string(ds[(c.i % 8 + 2):], '') END AS r, c.n
  FROM {name}{k} c JOIN {name}p{k} p ON c.g = p.g AND c.i // 8 = p.j)""")
        out.append(f"""{name}{k + 1} AS (SELECT g, j AS i, CASE WHEN n = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END AS d,
  count(*) OVER (PARTITION BY g) AS n FROM {name}p{k})""")
    return ",\n".join(out)


def _sql_merkle(levels: int = 7, top: int = 3) -> str:
    def part(c):
        return f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"
    head = " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars"))
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
      lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295::BIGINT)"""
    inner = " ".join(f"JOIN bs{k} x{k} ON x{k}.g = v.g AND x{k}.i = v.i // {8 ** k}" for k in range(levels))
    outer = " ".join(f"JOIN cs{k} y{k} ON y{k}.i = q.i // {8 ** k}" for k in range(top))
    steps = [f"x{k}" for k in range(levels)] + [f"y{k}" for k in range(top)]
    beside = " || ".join(f"{s}.l || {s}.r" for s in steps)
    sides = ", ".join(f"{{'l': {s}.l, 'r': {s}.r, 'n': {s}.n}}" for s in steps)
    return f"""
WITH a AS (SELECT doc_id, coalesce('=' || lang, '') AS g, sha256({head} || {part('text')}) AS d,
    CASE WHEN {crc} % 3 = 0 THEN sha256({head} || {part(low)}) END AS t FROM documents),
v AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS i FROM a),
{_sql_tree('v', 'b', levels)},
q AS (SELECT '' AS g, g AS lang, d, row_number() OVER (ORDER BY g) - 1 AS i FROM b{levels}),
{_sql_tree('q', 'c', top)},
w AS (SELECT v.doc_id, v.d AS leaf, coalesce(v.t, v.d) AS bad, q.d AS subroot, (SELECT d FROM c{top}) AS root,
    sha256({beside}) AS proof_sha256, [{sides}] AS path
  FROM v {inner} JOIN q ON q.lang = v.g {outer}),
z AS (SELECT *, list_reduce(list_concat([{{'l': '', 'r': bad, 'n': 0::BIGINT}}], path), lambda f, s:
    {{'l': '', 'r': CASE WHEN s.n = 1 THEN f.r ELSE sha256(s.l || f.r || s.r) END, 'n': 0::BIGINT}}).r AS folded_root FROM w)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM z
"""


OP12_SQL = _sql_merkle()


def op13_top_order_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of two to four words."""
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


OP13_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, k, unnest(list_transform(generate_series(1, len(ws) - k + 1), lambda i: array_to_string(ws[i:(i + k - 1)], ' '))) AS phrase
  FROM w, generate_series(1, 4) AS s(k) WHERE len(ws) >= k),
c AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE k = 1 GROUP BY ALL),
a AS (SELECT *, string_split(phrase, ' ') AS ws FROM c WHERE k > 1 AND f >= 30),
u AS (SELECT lang, phrase, k, f, j, array_to_string(ws[1:j], ' ') AS lp, array_to_string(ws[(j + 1):], ' ') AS rp
  FROM a, generate_series(1, 3) AS s(j) WHERE j < k),
v AS (SELECT u.*, l.f AS l, r.f AS r, (2000000::HUGEINT * u.f // (l.f + r.f))::BIGINT AS score
  FROM u JOIN c l ON l.lang = u.lang AND l.phrase = lp JOIN c r ON r.lang = u.lang AND r.phrase = rp),
b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
i AS (SELECT lang, f, array_to_string(ws[s:(s + m - 1)], ' ') AS phrase
  FROM a, generate_series(2, 3) AS x(m), generate_series(1, 3) AS y(s) WHERE m < k AND s + m - 1 <= k),
h AS (SELECT lang, phrase, max(f) AS longer FROM i GROUP BY ALL),
z AS (SELECT b.* FROM b LEFT JOIN h ON h.lang = b.lang AND h.phrase = b.phrase
  WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * b.f)
SELECT z.lang, row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, f DESC, phrase) AS rank, phrase,
       f AS a, l, r, n, score
FROM z JOIN t ON t.lang = z.lang QUALIFY rank <= 2000
"""


def queries() -> dict:
    return {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit() and callable(v)}


def oracle_sql() -> dict[str, str]:
    return {"op2_chat_format": OP2_SQL, "op11_rare_token_index": OP11_SQL, "op12_merkle_intervals": OP12_SQL,
            "op13_top_order_phrases": OP13_SQL}
