"""SQL spellings shared by the oracles (DuckDB dialect; its regex engine is RE2)."""

# White space as Unicode sees it, plus the information separators.
WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NOT_WS = WS.replace("[", "[^", 1)
TOKEN = r"[\p{L}\p{M}\p{N}]+|[^\s\p{L}\p{M}\p{N}]"
FOOTER = (
    WS + r"*ORCID:" + WS + r"*.*?Content not peer-reviewed by ChemRxiv\. License:"
    + WS + r"*CC BY(?:-[A-Za-z]+)*" + WS + "*4\\.0"
)


def strip_urls(x: str) -> str:
    return f"regexp_replace({x}, 'https?://{NOT_WS}+', '', 'g')"


def strip_footer(x: str) -> str:
    return f"regexp_replace({x}, '{FOOTER}', '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def normalize(x: str) -> str:
    return collapse(strip_footer(strip_urls(f"nfc_normalize({x})")))


def words(x: str) -> str:
    """Words of a single-spaced text."""
    return f"(CASE WHEN {x} = '' THEN 0 ELSE len(string_split({x}, ' ')) END)"


def tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{TOKEN}')"


DIRTY = """dirty AS (
  SELECT d.doc_id, CASE d.doc_id % 5
    WHEN 0 THEN d.text || ' see ' || coalesce(p.url, 'https://example.org/none') || ' there'
    WHEN 1 THEN d.text || ' e' || chr(769) || 'tude'
    WHEN 2 THEN d.text || ' ORCID: 0000-0001 a' || (CASE WHEN d.doc_id % 2 = 0 THEN '' ELSE chr(10) || 'b' END)
                || ' Content not peer-reviewed by ChemRxiv. License: CC BY-NC-ND 4.0 rest'
    WHEN 3 THEN chr(160) || ' ' || d.text || chr(160) || chr(8195) || chr(9) || ' end' || chr(12288)
    ELSE d.text END AS text
  FROM documents d LEFT JOIN pages p ON p.page_id * 4 = d.doc_id)"""

LINES = """lines AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS id,
         unnest(range(len(string_split(text, chr(10))))) AS pos,
         unnest(string_split(text, chr(10))) AS paragraph
  FROM documents)"""

# Paragraph texts that the TEI documents hold, by division and place; copies from nesting.
TEI = f"""{LINES},
tei AS (
  SELECT l.doc_id, l.id, n.copy, CAST(l.pos // 4 AS BIGINT) AS div, l.pos, {strip("l.paragraph")} AS text
  FROM lines l JOIN (SELECT 0 AS copy UNION ALL SELECT 1) n ON n.copy = 0 OR l.doc_id % 7 = 0
  WHERE l.doc_id % 11 <> 0 AND l.doc_id % 13 <> 0 AND {strip("l.paragraph")} <> '')"""

COUNTS = f"""counts AS (
  SELECT word, count(*) AS n FROM (SELECT unnest({tokens("text")}) AS word FROM benchmark) GROUP BY word)"""

MODEL = f"""{COUNTS},
model AS (
  SELECT word, log2(n) - log2((SELECT sum(n) FROM counts)) AS logp FROM counts
  UNION ALL
  SELECT '<unk>', log2(sqrt(count(*)) + 1) - log2(sum(n)) FROM counts)"""


def scores(source: str, key: str, text: str) -> str:
    """CTE ``scores(key, score)``: mean log2 probability of the tokens of ``text``."""
    return f"""toks AS (SELECT {key}, unnest({tokens(text)}) AS word FROM {source}),
scores AS (
  SELECT {key}, sum(coalesce(m.logp, (SELECT logp FROM model WHERE word = '<unk>'))) / count(*) AS score
  FROM toks LEFT JOIN model m ON m.word = toks.word GROUP BY ALL)"""


# Hits after dropping cut lines and empty ids, first line of an id (the repeats come later).
HITS = """raw_hits AS (
  SELECT doc_id, doc_id AS seq, text, lang, source, string_split(text, chr(10))[1] AS title FROM documents
  WHERE doc_id % 40 <> 7
  UNION ALL
  SELECT doc_id, doc_id + 1099511627776, text, lang, source, 'second version' FROM documents WHERE doc_id % 50 = 0),
all_hits AS (
  SELECT CASE WHEN doc_id % 30 = 29 THEN '' WHEN doc_id % 30 = 28 THEN NULL ELSE CAST(doc_id AS VARCHAR) END AS id, *
  FROM raw_hits),
hits AS (SELECT * FROM all_hits WHERE coalesce(id, '') <> ''),
first_hits AS (
  SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn FROM hits) WHERE rn = 1)"""

HIT_KEYWORDS = "CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN 'solo' ELSE lang || '; ' || source END"
HIT_AUTHORS = """(CASE doc_id % 6
    WHEN 0 THEN coalesce(string_split(c_name, '#')[1], 'Anon') || '; '
    WHEN 1 THEN ''
    ELSE CASE WHEN c_name IS NULL THEN 'Anon; ' ELSE string_split(c_name, '#')[1] || ' ' || string_split(c_name, '#')[2] || '; ' END
  END) || 'Ada ' || lang"""
HIT_URL = "CASE WHEN doc_id % 4 > 1 THEN 'https://x/' || CAST(doc_id AS VARCHAR) || '.pdf' END"
HIT_COLUMNS = f"""id, '10.1/' || CAST(doc_id AS VARCHAR) AS doi, title, text AS abstract,
  '2024-01-02T00:00:00Z' AS "publishedDate", '2024-01-01T00:00:00Z' AS "submittedDate", 'PUBLISHED' AS status,
  CASE WHEN doc_id % 2 = 0 THEN '1' END AS version,
  CASE WHEN doc_id % 3 <> 0 THEN 'CC BY 4.0' END AS license,
  {HIT_KEYWORDS} AS keywords, {HIT_AUTHORS} AS authors, {HIT_URL} AS pdf_url"""

# Compound records: references, retained descriptions and synonyms from the base tables.
LINKS = """links AS (
  SELECT l.p, s.s_suppkey AS k, s.s_name, s.s_nationkey, min(s.s_suppkey) OVER (PARTITION BY l.p) AS first_k
  FROM (SELECT DISTINCT l_partkey AS p, l_suppkey AS s FROM lineitem) l
  JOIN supplier s ON s.s_suppkey = l.s JOIN part ON p_partkey = l.p)"""
DESCRIPTIONS = f"""{LINKS},
descr AS (
  SELECT p_partkey AS cid, p_name AS title, k,
         CASE WHEN p_partkey % 7 = 2 AND k = first_k THEN 'latest' ELSE p_name || ' from ' || s_name END AS text,
         s_name, s_nationkey
  FROM links JOIN part ON p_partkey = p
  WHERE p_partkey % 7 <> 3 AND k <> 111)"""
SYNONYMS = """(CASE WHEN p_partkey % 5 = 0 THEN [] ELSE
  [x FOR x IN [p_name, p_brand, p_type, '12', left(p_name, 2), left(p_name, 3), repeat('ab', 60), repeat('a', 105),
               'a' || chr(1633) || chr(1634), '1a2', p_name]
    IF NOT regexp_matches(x, '\\p{Nd}\\p{Nd}') AND regexp_matches(x, '[a-zA-Z]') AND length(x) BETWEEN 3 AND 105] END)"""

# Responses: ten kinds of answer lines.
RESPONSES = """resp AS (
  SELECT conv_id, turn, CAST((conv_id + turn) % 10 AS INTEGER) AS kind, 'Q ' || text AS q, text,
         CAST(conv_id AS VARCHAR) || '__' || CAST(turn AS VARCHAR) AS custom_id
  FROM conversations),
answered AS (
  SELECT *, CASE WHEN kind = 4 THEN 0 ELSE length(text) END AS completion_tokens,
         CASE kind WHEN 3 THEN NULL WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN '5' WHEN 9 THEN 'cut of' ELSE q END AS question
  FROM resp WHERE kind NOT IN (0, 1, 7))"""

CACHE = """cache AS (
  SELECT d.doc_id, d.source, d.text, toxic = 1 AS failed,
         CASE WHEN toxic = 1 THEN NULL ELSE 'Q ' || d.text END AS question,
         CASE WHEN toxic = 1 THEN 0 ELSE n_chars END AS input_tokens,
         CASE WHEN toxic = 1 THEN 0 ELSE 7 END AS output_tokens,
         CASE WHEN toxic = 1 THEN 0 ELSE (d.doc_id % 100) / 4 END AS latency,
         printf('2024-01-%02d', CAST(d.doc_id % 9 + 1 AS INTEGER)) AS day
  FROM documents d JOIN labels USING (doc_id))"""
NAMES = """names AS (
  SELECT p_partkey AS id, CASE p_partkey % 10 WHEN 0 THEN 'note_' || p_partkey || '.json'
    WHEN 1 THEN 'cid_' || p_partkey || '.txt' ELSE 'cid_' || p_partkey || '.json' END AS name FROM part)"""
PROMPT = """'Ask {"question": ""} about' || chr(10) || text || chr(10) || 'END $1 ' || chr(92)"""
TOKEN_ESTIMATE = r"len(regexp_extract_all({x}, '\p{{L}}+|\p{{N}}{{1,3}}|[^\s\p{{L}}\p{{N}}]+'))"
