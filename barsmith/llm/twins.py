"""SQL for the queries that SQL can express."""

_TOKENS = "len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\v\\f\\r]+'))"


def _hash(*parts: str) -> str:
    joined = " || ':' || ".join(f"coalesce(({p})::VARCHAR, 'null')" for p in parts)
    return f"('0x' || substr(md5({joined}), 1, 15))::BIGINT"


MIXING = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, {_TOKENS} AS n, {_hash("doc_id", "text")} AS id_hash FROM documents
), totals AS (
  SELECT source, sum(n)::DOUBLE AS tokens, count(*) AS size, sum(sum(n)) OVER ()::DOUBLE AS total
  FROM docs GROUP BY source HAVING sum(n) > 0
), bisected AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT step + 1,
    CASE WHEN ln(z) - plogp / z >= 0.95 * ln(k) THEN (low + high) / 2 ELSE low END,
    CASE WHEN ln(z) - plogp / z >= 0.95 * ln(k) THEN high ELSE (low + high) / 2 END
  FROM (
    SELECT step, low, high, sum(p) AS z, sum(p * ln(p)) AS plogp, count(*)::DOUBLE AS k
    FROM (SELECT step, low, high, pow(tokens / total, (low + high) / 2) AS p FROM bisected, totals WHERE step < 32)
    GROUP BY step, low, high
  )
), whole AS (
  SELECT ln(sum(p)) - sum(p * ln(p)) / sum(p) >= 0.95 * ln(count(*)::DOUBLE) AS met
  FROM (SELECT tokens / total AS p FROM totals)
), tau AS (
  SELECT round(CASE WHEN (SELECT count(*) FROM totals) < 2 OR met THEN 1.0 ELSE low END, 9) AS tau
  FROM bisected, whole WHERE step = 32
), weights AS (
  SELECT source, tokens, total, size,
    round(exact * pow(10.0, floor(-log10(exact))), 9) / pow(10.0, floor(-log10(exact))) AS weight
  FROM (SELECT *, pow(tokens / total, tau) / (SELECT sum(pow(tokens / total, tau)) FROM totals, tau) AS exact FROM totals, tau)
), sources AS (
  SELECT source, floor(weight * total)::BIGINT // tokens::BIGINT AS epochs,
    floor(weight * total)::BIGINT % tokens::BIGINT AS rest, ceil(size / 1024.0)::BIGINT AS blocks
  FROM weights
), dealt AS (
  SELECT d.*, s.epochs, s.rest, s.blocks, id_hash % blocks AS block,
    {_hash("7", "d.source", "id_hash % blocks", "epochs")} AS slot, {_hash("id_hash", "epochs")} AS place
  FROM docs d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source
), blocks AS (
  SELECT *, sum(n) OVER (PARTITION BY source ORDER BY slot, block) AS upto
  FROM (SELECT source, rest, slot, block, sum(n) AS n FROM dealt GROUP BY ALL)
), cut AS (
  SELECT source, min({{'slot': slot, 'block': block, 'lack': rest - upto + n}}) AS cut FROM blocks WHERE upto > rest GROUP BY source
), taken AS (
  SELECT d.*, CASE WHEN c.cut IS NULL OR (d.slot, d.block) < (c.cut.slot, c.cut.block) THEN true
    WHEN (d.slot, d.block) = (c.cut.slot, c.cut.block)
    THEN sum(n) OVER (PARTITION BY d.source, d.slot, d.block ORDER BY place) <= c.cut.lack ELSE false END AS partial
  FROM dealt d LEFT JOIN cut c ON d.source IS NOT DISTINCT FROM c.source
), used AS (
  SELECT doc_id, source, id_hash, block, unnest(generate_series(0, epochs + partial::BIGINT - 1)) AS epoch FROM taken
)
SELECT doc_id, source, epoch, {_hash("7", "source", "block", "epoch")} AS slot, {_hash("id_hash", "epoch")} AS place
FROM used
"""

_WORDS = "trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g'))"

QUOTATION = f"""
WITH RECURSIVE turns AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, {_WORDS} AS words FROM conversations),
wrote AS (SELECT DISTINCT conv_id, words, turn AS at FROM turns WHERE words <> ''),
once AS (
  SELECT conv_id, turn, m.text AS text, m.role AS role,
    trim(regexp_replace(lower(m.text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS words
  FROM (SELECT conv_id, turn, min({{'text': text, 'role': coalesce(role, '')}}) AS m FROM turns GROUP BY ALL)
), quoted AS (
  SELECT t.*, p.words AS one, pp.words AS two, pp.role AS said,
    w.at AS at1, ww.at AS at2
  FROM turns t
  LEFT JOIN once p ON p.conv_id = t.conv_id AND p.turn = t.turn - 1
  LEFT JOIN once pp ON p.conv_id IS NOT NULL AND pp.conv_id = t.conv_id AND pp.turn = t.turn - 2
  ASOF LEFT JOIN wrote w ON w.conv_id = t.conv_id AND w.words = p.words AND t.turn > w.at
  ASOF LEFT JOIN wrote ww ON ww.conv_id = t.conv_id AND ww.words = pp.words AND t.turn > ww.at
), answers AS (SELECT *, coalesce(at1, at2) AS parent FROM quoted),
nodes AS (SELECT conv_id, turn, min(parent) AS parent FROM answers GROUP BY ALL),
up AS (
  SELECT conv_id, turn, turn AS root, 0::BIGINT AS depth FROM nodes WHERE parent IS NULL
  UNION ALL
  SELECT n.conv_id, n.turn, u.root, u.depth + 1 FROM nodes n JOIN up u ON u.conv_id = n.conv_id AND u.turn = n.parent
)
SELECT a.conv_id, a.turn, a.role, a.parent, u.root, u.depth,
  ((coalesce(one, '') <> '')::BIGINT + (coalesce(two, '') <> '')::BIGINT + (two IS NOT NULL)::BIGINT) AS quoted,
  ((at1 IS NOT NULL)::BIGINT + (at2 IS NOT NULL)::BIGINT) AS found, a.text AS own
FROM answers a JOIN up u ON u.conv_id = a.conv_id AND u.turn = a.turn
"""

# Base32 of a SHA-1: eight times five hex digits, and each time four letters of five bits.
ARCHIVES = """
WITH hashed AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
lasts AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS last FROM hashed)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(8), lambda g: array_to_string(list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, g * 5 + 1, 5))::BIGINT >> s) & 31) + 1)::INTEGER, 1)
  ), '')), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM lasts
"""

_TERMS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""

RANKING = f"""
WITH texts AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
whole AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS length FROM texts WHERE len(terms) > 0),
postings AS (
  SELECT doc_id, term, n, count(*) AS tf FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM texts) GROUP BY ALL
), asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, whole GROUP BY term, docs
), scores AS (
  SELECT item_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // length))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term), whole GROUP BY ALL
), ranks AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT * FROM ranks WHERE rank <= 10
"""

SQL = {
    "op3_mixing": MIXING,
    "op4_quotation_linking": QUOTATION,
    "op11_warc_zip": ARCHIVES,
    "op13_lexical_search": RANKING,
}
