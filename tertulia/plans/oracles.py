r"""The registered queries in ANSI SQL, for DuckDB over the same tables.

Written from the definitions, not from the Spark plans: the pattern classes are the plain ones, phrases are merged by run
numbering, windows are counted by merging intervals, and graph walks are recursive queries.
"""

from __future__ import annotations

# Spark's English stop words, in its order. The SQL must not need a session or Spark's files.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its
itself they them their theirs themselves what which who whom this that these those am is are was were be been being
have has had having do does did doing a an the and but if or because as until while of at by for with about against
between into through during before after above below to from up down in out on off over under again further then once
here there when where why how all any both each few more most other some such no nor not only own same so than too
very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm
you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's
there's what's when's where's who's why's would
""".split()

_POSTS = """
posts AS (
  SELECT d.doc_id AS post_id, CAST(e.user_id AS VARCHAR) AS author,
         CASE WHEN d.doc_id % 50 = 7 THEN NULL ELSE d.text END AS content,
         CASE WHEN d.doc_id % 50 = 7 THEN NULL
              ELSE concat_ws(' ', d.text, concat('#', e.event_type), concat('#', d.lang), p.url) END AS content_tagged,
         strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS date, e.props AS context, p.url AS link, e.event_type AS domain_group,
         d.lang AS country, d.source AS type,
         CAST(CASE d.lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 ELSE 3 END AS INTEGER) AS topic,
         d.text AS full_text
  FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id LEFT JOIN pages p ON p.page_id = d.doc_id)"""

_SPACE = r"[\s\p{Z}]"
_NOT_SPACE = r"[^\s\p{Z}]"


def _at(x: str) -> str:
    return rf"regexp_replace({x}, '{_NOT_SPACE}*@{_NOT_SPACE}*{_SPACE}?', '', 'g')"


def _space(x: str) -> str:
    return rf"regexp_replace({x}, '{_SPACE}+', ' ', 'g')"


def _quotes(x: str) -> str:
    return f"replace({x}, chr(39), '')"


def _urls(x: str) -> str:
    return rf"regexp_replace({x}, '(https?://)?([\p{{Nd}}a-z.\-]+)\.([a-z.]{{2,6}})([/\p{{L}}\p{{N}}_ .\-]*)', '', 'g')"


def _tickers(x: str) -> str:
    return rf"regexp_replace({x}, '\$[\p{{L}}\p{{N}}_]*', '', 'g')"


def _rt(x: str) -> str:
    return rf"regexp_replace({x}, '^RT{_SPACE}+', '')"


def _vowels(x: str) -> str:
    return f"translate({x}, 'áéíóúü', 'aeiouu')"


def _punct(x: str) -> str:
    return rf"""regexp_replace({x}, '[¡!"$%&''()*+,\-./:;<=>?\[\\\]`{{|}}~]', ' ', 'g')"""


def _repeats(x: str) -> str:
    """Between single blanks: a piece that begins with the word that ends the piece before loses that word and the blank."""
    pairs = f"list_zip(string_split({x}, ' '), list_prepend(NULL, string_split({x}, ' '))[:-2])"
    last = r"regexp_extract(p[2], '[\p{L}\p{N}_]+$')"
    first = r"regexp_extract(p[1], '^[\p{L}\p{N}_]+')"
    piece = f"CASE WHEN p[2] IS NULL THEN p[1] WHEN {last} <> '' AND {last} = {first} THEN substr(p[1], len({first}) + 1) "
    piece += "ELSE concat(' ', p[1]) END"
    return f"array_to_string(list_transform({pairs}, lambda p: {piece}), '')"


def _tokens(x: str, deaccent: bool = True) -> str:
    text = f"strip_accents(lower({x}))" if deaccent else f"lower({x})"
    found = rf"regexp_extract_all({text}, '[\p{{L}}\p{{Nl}}\p{{No}}_]+')"
    return f"list_filter({found}, lambda t: len(t) BETWEEN 2 AND 15 AND NOT starts_with(t, '_'))"


def _before_emoji(x: str) -> str:
    return _vowels(f"lower({_rt(_tickers(_urls(_quotes(_space(_at(x))))))})")


def _clean_ctes(source: str, column: str) -> str:
    return f"""
half AS (SELECT *, {_punct(_before_emoji(column))} AS spaced FROM {source}),
tokens AS (SELECT * EXCLUDE (spaced), {_tokens(_repeats('spaced'))} AS processed FROM half)"""


_TOKENS = _POSTS + "," + _clean_ctes("posts", "full_text")
_WORDS = _TOKENS + ",\nwords AS (SELECT post_id, topic, date, unnest(processed) AS word FROM tokens)"
_FOLDED = _WORDS + """,
topic_words AS (SELECT topic, word, count(*) AS n
  FROM (SELECT topic, translate(word, 'áéíóú', 'aeiou') AS word FROM words) WHERE word <> '' GROUP BY ALL),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY topic ORDER BY n DESC, word) AS INTEGER) AS rank FROM topic_words)"""
_TIMELINE = _TOKENS + """,
joined AS (SELECT post_id, topic, date, author, array_to_string(processed, ' ') AS processed FROM tokens),
timeline AS (SELECT date, topic, processed, unnest(list_append(string_split(processed, ' '), '')) AS word
  FROM joined WHERE date IS NOT NULL)"""
_PHRASES = _TOKENS + """,
uni AS (SELECT w AS a, count(*) AS n FROM (SELECT unnest(processed) AS w FROM tokens) GROUP BY ALL),
bi AS (SELECT p[1] AS a, p[2] AS b, count(*) AS n
  FROM (SELECT unnest(list_zip(processed[1:len(processed)-1], processed[2:])) AS p FROM tokens WHERE len(processed) > 1)
  GROUP BY ALL),
phrases AS (SELECT bi.a, bi.b, bi.n,
    (bi.n - 5) / CAST(x.n * y.n AS DOUBLE) * ((SELECT count(*) FROM uni) + (SELECT count(*) FROM bi)) AS score
  FROM bi JOIN uni x ON x.a = bi.a JOIN uni y ON y.a = bi.b
  WHERE (bi.n - 5) / CAST(x.n * y.n AS DOUBLE) * ((SELECT count(*) FROM uni) + (SELECT count(*) FROM bi)) > 20)"""


def _stop_words() -> str:
    """The English list plus the extra words, as SQL literals."""
    words = [*ENGLISH_STOP_WORDS, "mas", "asi", "aca"]
    return ", ".join("'" + w.replace("'", "''") + "'" for w in dict.fromkeys(words))


def _merged(source: str, out: str) -> str:
    """Greedy merge of phrases in ``source.processed``, giving ``out(post_id, processed)``."""
    return f"""
pos AS (SELECT post_id, unnest(processed) AS w, generate_subscripts(processed, 1) AS i FROM {source}),
pairs AS (SELECT post_id, i, w, lead(w) OVER (PARTITION BY post_id ORDER BY i) AS nxt FROM pos),
hit AS (SELECT p.post_id, p.i, p.i - row_number() OVER (PARTITION BY p.post_id ORDER BY p.i) AS run
  FROM pairs p JOIN phrases f ON f.a = p.w AND f.b = p.nxt),
nth AS (SELECT post_id, i, row_number() OVER (PARTITION BY post_id, run ORDER BY i) AS k FROM hit),
starts AS (SELECT post_id, i FROM nth WHERE k % 2 = 1),
merged AS (SELECT p.post_id, p.i, CASE WHEN s.i IS NULL THEN p.w ELSE concat(p.w, '_', p.nxt) END AS w
  FROM pairs p LEFT JOIN starts s ON s.post_id = p.post_id AND s.i = p.i
  WHERE NOT EXISTS (SELECT 1 FROM starts t WHERE t.post_id = p.post_id AND t.i = p.i - 1)),
{out} AS (SELECT t.post_id, coalesce(m.l, []) AS processed FROM {source} t
  LEFT JOIN (SELECT post_id, list(w ORDER BY i) AS l FROM merged GROUP BY post_id) m ON m.post_id = t.post_id)"""


_LEXICON = """
lex AS (SELECT word AS form, pos, regexp_replace(word, '(ing|er)$', '') AS lemma FROM (
  SELECT DISTINCT word, CASE WHEN len(word) = 2 THEN 'DET' WHEN word LIKE '%tion' THEN 'NOUN' WHEN word LIKE '%ly' THEN 'ADV'
    WHEN word LIKE '%ing' THEN 'VERB' WHEN word LIKE '%er' THEN 'ADJ' END AS pos FROM words) WHERE pos IS NOT NULL)"""


def _lemmas(source: str, out: str) -> str:
    return f"""
{out}_w AS (SELECT post_id, unnest(processed) AS w, generate_subscripts(processed, 1) AS i FROM {source}),
{out} AS (SELECT t.post_id, coalesce(m.l, []) AS processed FROM {source} t LEFT JOIN (
  SELECT post_id, list(coalesce(lemma, w) ORDER BY i) AS l FROM {out}_w LEFT JOIN lex ON form = w
  WHERE pos IS NULL OR pos IN ('NOUN', 'ADJ', 'VERB', 'ADV', 'PROPN', 'NUM') GROUP BY post_id) m ON m.post_id = t.post_id)"""


_CURVE = _WORDS + """,
counts AS (SELECT word, count(*) AS n FROM words GROUP BY word),
top AS (SELECT row_number() OVER (ORDER BY n DESC, word) AS k, n FROM counts ORDER BY n DESC, word LIMIT 12),
curve AS (SELECT CAST(k AS INTEGER) AS k,
  round(sum(n) OVER (ORDER BY k) / (SELECT CAST(sum(n) AS DOUBLE) FROM counts), 6) AS coherence FROM top)"""

_VOCAB = _TOKENS + """,
dw AS (SELECT DISTINCT post_id, topic, unnest(processed) AS term FROM tokens),
docs AS (SELECT topic, count(*) AS n_docs FROM tokens GROUP BY topic),
dfs AS (SELECT topic, term, count(*) AS df, count(*) / CAST(any_value(n_docs) AS DOUBLE) AS freq
  FROM dw JOIN docs USING (topic) GROUP BY topic, term),
vocab AS (SELECT topic, term, df, freq FROM dfs
  QUALIFY row_number() OVER (PARTITION BY topic ORDER BY df DESC, term) <= 500)"""
_EDGES = _VOCAB + """,
vw AS MATERIALIZED (SELECT post_id, topic, term, df FROM dw JOIN vocab USING (topic, term)),
edges AS MATERIALIZED (SELECT a.topic, a.term AS src, b.term AS dst,
    count(*) / sqrt(CAST(any_value(a.df) * any_value(b.df) AS DOUBLE)) AS weight
  FROM vw a JOIN vw b ON a.post_id = b.post_id AND a.topic = b.topic AND a.term < b.term GROUP BY a.topic, a.term, b.term)"""


def _closeness(rounds: int = 6) -> str:
    """Sets of reached nodes as bit strings, one step per round; graphs of frequent terms are far less than 6 deep."""
    sql = _EDGES + """,
arcs AS MATERIALIZED (SELECT topic, src, dst FROM edges UNION ALL SELECT topic, dst, src FROM edges),
node AS MATERIALIZED (SELECT topic, src AS term, row_number() OVER (PARTITION BY topic ORDER BY src) - 1 AS id
  FROM (SELECT DISTINCT topic, src FROM arcs)),
r0 AS MATERIALIZED (SELECT topic, term, set_bit(repeat('0', 500)::BIT, id::INTEGER, 1) AS reach FROM node)"""
    for i in range(rounds):
        sql += f""",
r{i + 1} AS MATERIALIZED (SELECT topic, term, bit_or(reach) AS reach FROM (
  SELECT b.topic, b.src AS term, r.reach FROM arcs b JOIN r{i} r ON r.topic = b.topic AND r.term = b.dst
  UNION ALL SELECT topic, term, reach FROM r{i}) GROUP BY topic, term)"""
    steps = " UNION ALL ".join(
        f"SELECT a.topic, a.term, bit_count(b.reach) - bit_count(a.reach) AS found, {i + 1} AS d "
        f"FROM r{i} a JOIN r{i + 1} b USING (topic, term)"
        for i in range(rounds)
    )
    return sql + f""",
steps AS ({steps}),
sums AS (SELECT topic, term, sum(found) AS r, sum(found * d) AS dist FROM steps GROUP BY topic, term),
size AS (SELECT topic, count(*) AS n FROM node GROUP BY topic),
deeper AS (SELECT count(*) AS n_deeper FROM r{rounds - 1} a JOIN r{rounds} b USING (topic, term) WHERE bit_count(b.reach) > bit_count(a.reach)),
closeness AS (SELECT topic, term, (r / CAST(dist AS DOUBLE)) * (r / CAST(n - 1 AS DOUBLE))
    * CASE WHEN n_deeper > 0 THEN error('the graph is deeper than the rounds of this query') ELSE 1 END AS closeness
  FROM sums JOIN size USING (topic) CROSS JOIN deeper)"""


def _betweenness(depth: int = 4) -> str:
    """Shortest paths level by level, then their shares back; a graph deeper than the levels is an error."""
    sql = _EDGES + """,
node AS MATERIALIZED (SELECT topic, term, CAST(row_number() OVER (PARTITION BY topic ORDER BY term) AS INTEGER) AS id
  FROM (SELECT topic, src AS term FROM edges UNION SELECT topic, dst FROM edges)),
half_arcs AS (SELECT e.topic, a.id AS s, b.id AS v FROM edges e JOIN node a ON a.topic = e.topic AND a.term = e.src
  JOIN node b ON b.topic = e.topic AND b.term = e.dst),
adj AS MATERIALIZED (SELECT topic, s, v FROM half_arcs UNION ALL SELECT topic, v, s FROM half_arcs),
p1 AS MATERIALIZED (SELECT topic, s, v, 1.0::DOUBLE AS paths FROM adj),
rest1 AS MATERIALIZED (SELECT a.topic, a.id AS s, b.id AS v FROM node a JOIN node b ON a.topic = b.topic AND a.id <> b.id
  ANTI JOIN p1 ON p1.topic = a.topic AND p1.s = a.id AND p1.v = b.id)"""
    for d in range(2, depth + 1):
        sql += f""",
p{d} AS MATERIALIZED (SELECT r.topic, r.s, r.v, sum(p.paths) AS paths FROM rest{d - 1} r
  JOIN adj a ON a.topic = r.topic AND a.s = r.v JOIN p{d - 1} p ON p.topic = r.topic AND p.s = r.s AND p.v = a.v GROUP BY ALL),
rest{d} AS MATERIALIZED (SELECT r.* FROM rest{d - 1} r ANTI JOIN p{d} p ON p.topic = r.topic AND p.s = r.s AND p.v = r.v)"""
    sql += f",\nd{depth} AS (SELECT topic, s, v, paths, 0.0::DOUBLE AS share FROM p{depth})"
    for d in range(depth - 1, 0, -1):
        sql += f""",
g{d} AS (SELECT x.topic, x.s, a.v, sum((1 + x.share) / x.paths) AS give FROM d{d + 1} x
  JOIN adj a ON a.topic = x.topic AND a.s = x.v GROUP BY ALL),
d{d} AS MATERIALIZED (SELECT p.topic, p.s, p.v, p.paths, coalesce(p.paths * g.give, 0) AS share FROM p{d} p
  LEFT JOIN g{d} g ON g.topic = p.topic AND g.s = p.s AND g.v = p.v)"""
    shares = " UNION ALL ".join(f"SELECT topic, v, share FROM d{d}" for d in range(1, depth))
    return sql + f""",
total AS (SELECT topic, v, sum(share) AS share FROM ({shares}) GROUP BY topic, v),
deeper AS (SELECT count(*) AS n_deeper FROM rest{depth} r JOIN adj a ON a.topic = r.topic AND a.s = r.v
  JOIN p{depth} p ON p.topic = r.topic AND p.s = r.s AND p.v = a.v),
size AS (SELECT topic, count(*) * CASE WHEN any_value(n_deeper) > 0
    THEN CAST(error('the graph is deeper than the levels of this query') AS BIGINT) ELSE 1 END AS n
  FROM node CROSS JOIN deeper GROUP BY topic)"""


_ADJACENT = _TOKENS + """,
adjacent AS (SELECT topic, p[1] AS word, p[2] AS next_word, count(*) AS n
  FROM (SELECT topic, unnest(list_zip(processed[1:len(processed)-1], processed[2:])) AS p FROM tokens WHERE len(processed) > 1)
  GROUP BY ALL)"""
_TOP_EDGES = _ADJACENT + """,
top_edges AS MATERIALIZED (SELECT topic, word, next_word, n FROM adjacent WHERE word <> next_word
  QUALIFY row_number() OVER (PARTITION BY topic ORDER BY n DESC, word, next_word)
    <= ceil(sqrt(count(*) OVER (PARTITION BY topic))))"""
_ACYCLIC = _TOP_EDGES + """,
walk AS (
  SELECT topic, word, next_word, n, next_word AS here FROM top_edges
  UNION
  SELECT w.topic, w.word, w.next_word, w.n, e.next_word FROM walk w JOIN top_edges e ON e.topic = w.topic AND e.word = w.here
    AND (e.n > w.n OR (e.n = w.n AND (e.word < w.word OR (e.word = w.word AND e.next_word < w.next_word))))),
acyclic AS MATERIALIZED (SELECT t.topic, t.word, t.next_word, t.n FROM top_edges t WHERE NOT EXISTS (
  SELECT 1 FROM walk w WHERE w.topic = t.topic AND w.word = t.word AND w.next_word = t.next_word AND w.here = t.word))"""
_STORY = _ACYCLIC + """,
depth AS (
  SELECT DISTINCT topic, word, 0 AS level FROM (SELECT topic, word FROM acyclic UNION SELECT topic, next_word FROM acyclic)
  UNION
  SELECT d.topic, a.next_word, d.level + 1 FROM depth d JOIN acyclic a ON a.topic = d.topic AND a.word = d.word),
story AS (SELECT topic, word, CAST(max(level) AS INTEGER) AS level FROM depth GROUP BY topic, word)"""

_COHERENCE = _FOLDED + """,
tt AS MATERIALIZED (SELECT topic AS mt, word FROM ranked WHERE rank <= 20),
spans AS (SELECT post_id, len(processed) AS n FROM tokens),
total AS (SELECT sum(greatest(n - 110, 0) + 1) AS t FROM spans),
spots AS (SELECT post_id, w, i - 1 AS p FROM (
    SELECT post_id, unnest(processed) AS w, generate_subscripts(processed, 1) AS i FROM tokens)
  WHERE w IN (SELECT word FROM tt)),
iv AS (SELECT post_id, w, p, greatest(0, p - 109) AS lo, least(p, greatest(n - 110, 0)) AS hi FROM spots JOIN spans USING (post_id)),
mk AS (SELECT *, max(hi) OVER (PARTITION BY post_id, w ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM iv),
ir AS (SELECT *, sum(CASE WHEN before IS NULL OR lo > before THEN 1 ELSE 0 END) OVER (PARTITION BY post_id, w ORDER BY p) AS isle FROM mk),
isle AS MATERIALIZED (SELECT post_id, w, isle, min(lo) AS lo, max(hi) AS hi FROM ir GROUP BY post_id, w, isle),
occ AS (SELECT w, sum(hi - lo + 1) AS c FROM isle GROUP BY w),
want AS (SELECT DISTINCT a.word AS a, b.word AS b FROM tt a JOIN tt b ON a.mt = b.mt),
co AS (SELECT x.w AS a, y.w AS b, sum(least(x.hi, y.hi) - greatest(x.lo, y.lo) + 1) AS c
  FROM isle x JOIN isle y ON x.post_id = y.post_id AND x.lo <= y.hi AND y.lo <= x.hi
  JOIN want ON want.a = x.w AND want.b = y.w GROUP BY x.w, y.w),
cell AS (SELECT a.mt, a.word AS a, b.word AS b,
    ln((coalesce(co.c, 0) / CAST(t AS DOUBLE) + 1e-12) / (oa.c / CAST(t AS DOUBLE) * (ob.c / CAST(t AS DOUBLE))))
      / -ln(coalesce(co.c, 0) / CAST(t AS DOUBLE) + 1e-12) AS v
  FROM tt a JOIN tt b ON a.mt = b.mt JOIN occ oa ON oa.w = a.word JOIN occ ob ON ob.w = b.word
  LEFT JOIN co ON co.a = a.word AND co.b = b.word CROSS JOIN total),
whole AS (SELECT mt, b, sum(v) AS s FROM cell GROUP BY mt, b),
cosine AS (SELECT mt, a, sum(v * s) / (sqrt(sum(v * v)) * sqrt(sum(s * s))) AS c FROM cell JOIN whole USING (mt, b) GROUP BY mt, a)"""

_SELECT_K = _CURVE + """,
unit AS (SELECT k, coherence, (k - min(k) OVER ()) / CAST(max(k) OVER () - min(k) OVER () AS DOUBLE) AS x,
  (coherence - min(coherence) OVER ()) / (max(coherence) OVER () - min(coherence) OVER ()) AS y FROM curve),
dif AS (SELECT k, coherence, x, y - x AS d FROM unit),
nb AS (SELECT *, lead(d) OVER (ORDER BY k) AS nd, lag(d) OVER (ORDER BY k) AS pd, x - lag(x) OVER (ORDER BY k) AS dx FROM dif),
mx AS (SELECT *, d >= coalesce(pd, d) AND d >= coalesce(nd, d) AS is_max, d <= coalesce(pd, d) AND d <= coalesce(nd, d) AS is_min,
  avg(dx) OVER () AS gap FROM nb),
tries AS (SELECT mx.*, s.i / 10.0::DOUBLE AS s FROM mx CROSS JOIN (SELECT unnest(range(1, 11)) AS i) s),
lim AS (SELECT s, k, nd,
  last_value(CASE WHEN is_min THEN 0.0 WHEN is_max THEN d - s * gap END IGNORE NULLS) OVER w AS lim,
  last_value(CASE WHEN is_max THEN k END IGNORE NULLS) OVER w AS knee FROM tries
  WINDOW w AS (PARTITION BY s ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
knees AS (SELECT * FROM lim WHERE knee IS NOT NULL AND nd < lim ORDER BY s DESC, k LIMIT 1)"""

_EMPIRICAL = _FOLDED + """,
tot AS (SELECT topic, sum(n) AS total FROM topic_words GROUP BY topic),
terms AS (SELECT topic, word, n, n / CAST(total AS DOUBLE) AS p FROM topic_words JOIN tot USING (topic)),
wn AS (SELECT word, sum(n) AS n_word FROM terms GROUP BY word),
alln AS (SELECT sum(total) AS n_all FROM tot),
scored AS (SELECT topic, word, p, n_word / CAST(n_all AS DOUBLE) AS pw, n / CAST(n_word AS DOUBLE) AS given,
  total / CAST(n_all AS DOUBLE) AS pt FROM terms JOIN wn USING (word) JOIN tot USING (topic) CROSS JOIN alln),
sal AS (SELECT word, any_value(pw) * sum(given * ln(given / pt)) AS saliency FROM scored GROUP BY word)"""

_DISTANCES = _EMPIRICAL + """,
grid AS (SELECT t.topic, w.word, coalesce(p.p, 0) AS p FROM tot t CROSS JOIN wn w
  LEFT JOIN terms p ON p.topic = t.topic AND p.word = w.word),
distances AS (SELECT a.topic AS topic_a, b.topic AS topic_b, sum(
  CASE WHEN a.p > 0 THEN a.p * ln(2 * a.p / (a.p + b.p)) ELSE 0 END + CASE WHEN b.p > 0 THEN b.p * ln(2 * b.p / (a.p + b.p)) ELSE 0 END
) / 2 AS distance FROM grid a JOIN grid b ON a.word = b.word AND a.topic < b.topic GROUP BY a.topic, b.topic)"""

_EMOJI = "CASE domain_group WHEN 'click' THEN '👍' WHEN 'view' THEN '👀' WHEN 'purchase' THEN '💰💰' ELSE '⚡' END"


def _with(ctes: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes.strip()}\n{select}"


def _step(name: str) -> str:
    """One step of the cleaning chain on the tagged text of every post."""
    return _with(_POSTS, f"SELECT post_id, {name} AS result FROM posts")


_TAGGED = "concat_ws(' ', full_text, concat('#', domain_group), concat('@', author), concat('$', type), link)"


def oracle_sql() -> dict[str, str]:
    """SQL per query name. Queries over fitted models have none."""
    stop = _stop_words()
    csv_columns = "author, content, date, context, link, domain_group, country, type"

    def _model_terms(n: int) -> str:
        return (
            f"SELECT topic, least({n}, terms) AS n_terms, least({n}, terms) AS n_known, true AS falling, true AS is_share "
            f"FROM (SELECT DISTINCT topic FROM tokens), (SELECT count(DISTINCT word) AS terms FROM words WHERE word NOT IN ({stop}))"
        )

    distribution = _with(
        _POSTS, "SELECT domain_group, count(*) AS count FROM posts WHERE domain_group IS NOT NULL GROUP BY domain_group"
    )
    return {
        "scan_csv": _with(_POSTS, f"SELECT {csv_columns} FROM posts"),
        "scan_csv_dir": _with(_POSTS, f"SELECT {csv_columns} FROM posts"),
        "empty_to_null": _with(_POSTS, "SELECT post_id, link, author FROM posts"),
        "skip_bad_lines": _with(
            _POSTS,
            "SELECT CAST(post_id AS VARCHAR) AS post_id, CASE WHEN country = 'es' THEN NULL ELSE domain_group END AS domain_group, "
            "CASE WHEN country = 'es' THEN NULL ELSE type END AS type FROM posts WHERE country <> 'de'",
        ),
        "scan_parquet": _with(_TOKENS, "SELECT post_id, array_to_string(processed, ' ') AS processed FROM tokens"),
        "scan_json": _with(
            _POSTS,
            "SELECT count(*) AS data_volume, count(content) AS with_text, count(DISTINCT domain_group) AS networks FROM posts",
        ),
        "scan_outputs_by_name": distribution,
        "scan_coherence": _with(_CURVE, "SELECT k, coherence FROM curve"),
        "write_processed": _with(
            _TOKENS, "SELECT CAST(post_id AS VARCHAR) AS post_id, nullif(array_to_string(processed, ' '), '') AS processed FROM tokens"
        ),
        "run_report": _with(
            _POSTS,
            "SELECT 'read' AS stage, count(*) AS rows FROM posts UNION ALL SELECT 'with_text', count(content) FROM posts "
            "UNION ALL SELECT 'distinct_text', count(DISTINCT content) FROM posts",
        ),
        "bow_store": _with(_WORDS, "SELECT post_id, word AS term, count(*) AS n FROM words GROUP BY post_id, word"),
        "run_layout": distribution,
        "coherence_resume": _with(_CURVE, "SELECT k FROM curve WHERE k NOT IN (SELECT k FROM curve WHERE coherence > 0.2)"),
        "normalize_columns": _with(_POSTS, f"SELECT post_id, {csv_columns} FROM posts"),
        "drop_null_content": _with(_POSTS, "SELECT post_id, content FROM posts WHERE content IS NOT NULL"),
        "filter_networks": _with(
            _POSTS, "SELECT post_id, domain_group FROM posts WHERE domain_group IN ('click', 'purchase', 'view')"
        ),
        "filter_has_hash": _with(_POSTS, "SELECT post_id, content_tagged FROM posts WHERE contains(content_tagged, '#')"),
        "head_n": _with(_POSTS, "SELECT post_id, date FROM posts ORDER BY post_id LIMIT 100"),
        "parse_date": _with(_POSTS, "SELECT post_id, CAST(date AS TIMESTAMP) AS date FROM posts"),
        "distinct_networks": _with(_POSTS, "SELECT DISTINCT domain_group FROM posts"),
        "stage_volumes": _with(
            _TOKENS,
            "SELECT 'read' AS stage, count(*) AS rows FROM posts UNION ALL SELECT 'with_text', count(content) FROM posts "
            "UNION ALL SELECT 'distinct_text', count(DISTINCT content) FROM posts "
            "UNION ALL SELECT 'distinct_tokens', count(DISTINCT processed) FROM tokens",
        ),
        "date_range": _with(
            _POSTS, "SELECT min(CAST(date AS TIMESTAMP)) AS first_date, max(CAST(date AS TIMESTAMP)) AS last_date FROM posts"
        ),
        "fill_empty_text": _with(_POSTS, "SELECT post_id, coalesce(content, '<EMPTY>') AS content FROM posts"),
        "drop_null_any": _with(
            _POSTS, "SELECT post_id, date, link, content FROM posts WHERE date IS NOT NULL AND link IS NOT NULL AND content IS NOT NULL"
        ),
        "union_sources": _with(
            _POSTS, "SELECT post_id, content, link FROM posts UNION ALL SELECT conv_id, text, NULL FROM conversations"
        ),
        "dedupe_content": _with(
            _POSTS,
            "SELECT post_id, content, domain_group FROM posts WHERE content IS NOT NULL "
            "QUALIFY row_number() OVER (PARTITION BY content ORDER BY post_id) = 1",
        ),
        "dedupe_tokens": _with(
            _TOKENS,
            "SELECT post_id, array_to_string(processed, ' ') AS processed FROM tokens "
            "QUALIFY row_number() OVER (PARTITION BY array_to_string(processed, ' ') ORDER BY post_id) = 1",
        ),
        "sample_fraction": _with(
            _POSTS, "SELECT post_id FROM posts WHERE md5(concat('42:', CAST(post_id AS VARCHAR))) < '40000000'"
        ),
        "sample_n": _with(
            _POSTS, "SELECT post_id FROM posts ORDER BY md5(concat('42:', CAST(post_id AS VARCHAR))), post_id LIMIT 150"
        ),
        "network_distribution": distribution,
        "repeated_posts": _with(
            _POSTS, "SELECT content, count(*) AS count FROM posts WHERE content IS NOT NULL GROUP BY content"
        ),
        "repeated_posts_top": _with(
            _POSTS,
            "SELECT content, count(*) AS count FROM posts WHERE content IS NOT NULL GROUP BY content HAVING count(*) > 1 "
            "ORDER BY count DESC, content LIMIT 15",
        ),
        "hashtag_counts": _with(
            _POSTS,
            r"SELECT h AS hashs, count(*) AS Conteo FROM (SELECT unnest(regexp_extract_all(replace(content_tagged, chr(10), ' '), "
            r"'#[\p{L}\p{N}_]+')) AS h FROM posts WHERE contains(content_tagged, '#')) GROUP BY h",
        ),
        "topic_distribution": _with(_POSTS, "SELECT topic, count(*) AS count FROM posts GROUP BY topic"),
        "topic_share": _with(
            _POSTS, "SELECT topic, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share FROM posts GROUP BY topic"
        ),
        "topic_timeline": _with(
            _POSTS, "SELECT CAST(date AS TIMESTAMP) AS date, topic, count(author) AS author FROM posts GROUP BY ALL"
        ),
        "word_count": _with(_WORDS, "SELECT word, count(*) AS n FROM words GROUP BY word"),
        "topic_word_count": _with(_FOLDED, "SELECT topic, word, n FROM topic_words"),
        "topic_weight_scale": _with(
            _FOLDED,
            "SELECT topic, round(ceil(max(CAST(n AS DOUBLE)) / 0.9::DOUBLE * 500) / 500, 6) AS scale FROM topic_words GROUP BY topic",
        ),
        "adjacent_words": _with(_ADJACENT, "SELECT topic, word, next_word, n FROM adjacent"),
        "doc_freq": _with(_VOCAB, "SELECT topic, term, df, round(freq, 6) AS freq FROM dfs"),
        "top_words_per_topic": _with(_FOLDED, "SELECT topic, word, n, rank FROM ranked WHERE rank <= 6"),
        "words_timeline_topic": _with(
            _TIMELINE + """,
folded AS (SELECT date, topic, processed, translate(word, 'áéíóú', 'aeiou') AS word FROM timeline WHERE word <> ''),
best AS (SELECT topic, word FROM (SELECT topic, word, count(*) AS n FROM folded GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY topic ORDER BY n DESC, word) <= 6)""",
            "SELECT date, topic, md5(processed) AS processed, word FROM folded SEMI JOIN best USING (topic, word)",
        ),
        "topic_terms_top_n": _with(
            _FOLDED, "SELECT topic, word, CAST(n AS DOUBLE) AS weight, rank FROM ranked WHERE rank <= 25"
        ),
        "vocab_top500": _with(_VOCAB, "SELECT topic, term, df, round(freq, 6) AS freq FROM vocab"),
        "top_sqrt_edges": _with(_TOP_EDGES, "SELECT topic, word, next_word, n FROM top_edges"),
        "join_topic_mix": _with(
            _POSTS,
            "SELECT post_id, topic, "
            + ", ".join(f"CASE WHEN topic = {i} THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END / 5 AS p{i}" for i in range(4))
            + " FROM posts",
        ),
        "join_word_count": _with(
            _FOLDED,
            "SELECT r.topic, r.word, coalesce(c.n, 0) AS n FROM ranked r "
            "LEFT JOIN (SELECT word, count(*) AS n FROM words GROUP BY word) c ON c.word = r.word WHERE r.rank <= 25",
        ),
        "semi_join_top_words": _with(
            _FOLDED,
            "SELECT w.post_id, w.topic, w.word FROM (SELECT post_id, topic, translate(word, 'áéíóú', 'aeiou') AS word FROM words) w "
            "SEMI JOIN (SELECT topic, word FROM ranked WHERE rank <= 6) r ON r.topic = w.topic AND r.word = w.word",
        ),
        "anti_join_stopwords": _with(
            _WORDS, f"SELECT word, count(*) AS n FROM words WHERE word NOT IN ({stop}) GROUP BY word"
        ),
        "join_nodes_metrics": _with(
            _closeness(),
            "SELECT v.topic, v.term, round(v.freq, 6) AS freq, "
            "CAST(row_number() OVER (PARTITION BY v.topic ORDER BY v.freq, v.term) - 1 AS INTEGER) AS rank, "
            "round(coalesce(c.closeness, 0), 6) AS closeness FROM vocab v LEFT JOIN closeness c ON c.topic = v.topic AND c.term = v.term",
        ),
        "extract_hashtags": _with(
            _POSTS,
            r"SELECT post_id, array_to_string(regexp_extract_all(replace(content_tagged, chr(10), ' '), '#[\p{L}\p{N}_]+'), ' ') "
            r"AS result FROM posts",
        ),
        "strip_at_tokens": _step(_at(_TAGGED)),
        "collapse_space": _step(_space(_TAGGED)),
        "strip_quotes": _step(_quotes(_TAGGED)),
        "strip_urls": _step(_urls(_TAGGED)),
        "strip_tickers": _step(_tickers(_TAGGED)),
        "strip_rt": _step(_rt("concat('RT ', full_text)")),
        "lower_text": _step(f"lower({_TAGGED})"),
        "fold_vowels": _step(_vowels(_TAGGED)),
        "demojize": _step(
            f"""replace(replace(replace(replace(concat(full_text, ' ', {_EMOJI}), '👍', ':thumbs_up_sign:'), '👀', ':eyes:'),
  '💰', ':money_bag:'), '⚡', ':high_voltage_sign:')"""
        ),
        "strip_punct": _step(_punct(_TAGGED)),
        "collapse_repeats": _step(_repeats(_punct(_space("full_text")))),
        "tokenize": _step(f"array_to_string({_tokens('full_text')}, ' ')"),
        "clean_text": _with(
            _POSTS + "," + _clean_ctes("posts", "content_tagged"),
            "SELECT post_id, CASE WHEN content_tagged IS NOT NULL THEN array_to_string(processed, ' ') END AS processed FROM tokens",
        ),
        "retokenize": _with(
            _PHRASES + "," + _merged("tokens", "applied"),
            f"SELECT post_id, array_to_string({_tokens(chr(39).join(['array_to_string(processed, ', ' ', ')']), False)}, ' ') AS processed FROM applied",
        ),
        "fold_tildes": _step("translate(full_text, 'áéíóú', 'aeiou')"),
        "join_tokens": _with(_TOKENS, "SELECT post_id, array_to_string(processed, ' ') AS processed FROM tokens"),
        "split_tokens": _with(
            _TIMELINE, "SELECT post_id, len(string_split(processed, ' ')) AS n, string_split(processed, ' ')[1] AS first FROM joined"
        ),
        "stopword_list": _with(
            _WORDS + f""",
listed AS (SELECT unnest([{stop}]) AS word)""",
            "SELECT l.word, count(w.word) AS n FROM listed l LEFT JOIN words w ON w.word = l.word GROUP BY l.word",
        ),
        "remove_stopwords": _with(
            _TOKENS,
            f"SELECT post_id, array_to_string(list_filter(processed, lambda t: t NOT IN ({stop})), ' ') AS processed FROM tokens",
        ),
        "phrase_counts": _with(
            _PHRASES, "SELECT a, NULL AS b, n FROM uni UNION ALL SELECT a, b, n FROM bi"
        ),
        "phrase_model": _with(_PHRASES, "SELECT a, b, n, round(score, 6) AS score FROM phrases"),
        "apply_phrases": _with(
            _PHRASES + f""",
bare AS (SELECT post_id, list_filter(processed, lambda t: t NOT IN ({stop})) AS processed FROM tokens),"""
            + _merged("bare", "applied"),
            "SELECT post_id, array_to_string(processed, ' ') AS processed FROM applied",
        ),
        "lemma_pos_filter": _with(
            _WORDS + "," + _LEXICON + "," + _lemmas("tokens", "lemmas"),
            "SELECT post_id, array_to_string(processed, ' ') AS processed FROM lemmas",
        ),
        "process_words": _with(
            _PHRASES + f""",
words AS (SELECT unnest(processed) AS word FROM tokens),
bare AS (SELECT post_id, list_filter(processed, lambda t: t NOT IN ({stop})) AS processed FROM tokens),"""
            + _merged("bare", "applied") + "," + _LEXICON + "," + _lemmas("applied", "lemmas"),
            "SELECT post_id, array_to_string(list_filter("
            + _tokens("array_to_string(processed, ' ')", False)
            + f", lambda t: t NOT IN ({stop})), ' ') AS processed FROM lemmas",
        ),
        "vocabulary": _with(
            _WORDS, "SELECT word AS term, count(*) AS cf, count(DISTINCT post_id) AS df FROM words GROUP BY word"
        ),
        "bag_of_words": _with(_WORDS, "SELECT post_id, word AS term, count(*) AS n FROM words GROUP BY post_id, word"),
        "binary_terms": _with(_VOCAB, "SELECT post_id, topic, term FROM dw"),
        "explode_words": _with(
            _TIMELINE,
            "SELECT date, topic, md5(processed) AS processed, unnest(string_split(processed, ' ')) AS word FROM joined WHERE date IS NOT NULL",
        ),
        "words_topic_timeline": _with(_TIMELINE, "SELECT date, topic, md5(processed) AS processed, word FROM timeline"),
        "lda_fit": _with(_WORDS, _model_terms(10)),
        "lda_range": _with(_POSTS, "SELECT CAST(unnest(range(2, 1 + count(DISTINCT topic))) AS INTEGER) AS k, true AS in_range FROM posts"),
        "topic_terms": _with(_WORDS, _model_terms(25)),
        "model_store": _with(
            _WORDS,
            f"SELECT CAST(topic AS INTEGER) AS topic, least(25, (SELECT count(DISTINCT word) FROM words WHERE word NOT IN ({stop}))) AS n_terms, "
            "CAST(0 AS BIGINT) AS n_different FROM (SELECT DISTINCT topic FROM tokens)",
        ),
        "classify": _with(_TOKENS, "SELECT post_id, true AS known_topic, true AS is_largest, 1.0::DOUBLE AS mix FROM tokens"),
        "topic_proba_wide": _with(_TOKENS, "SELECT post_id, true AS topic_has_largest, 1.0::DOUBLE AS mix FROM tokens"),
        "topic_projection_2d": _with(_TOKENS, "SELECT post_id, true AS on_plane, true AS own_colour FROM tokens"),
        "visual_payload": _with(
            _EDGES + _STORY.removeprefix(_TOKENS),
            """SELECT w.topic, w.weights, n.nodes, e.edges, s.story FROM
  (SELECT topic, least(25, count(DISTINCT translate(term, 'áéíóú', 'aeiou'))) AS weights FROM dw GROUP BY topic) w
  LEFT JOIN (SELECT topic, count(*) AS nodes FROM vocab GROUP BY topic) n ON n.topic = w.topic
  LEFT JOIN (SELECT topic, count(*) AS edges FROM edges GROUP BY topic) e ON e.topic = w.topic
  LEFT JOIN (SELECT topic, count(*) AS story FROM story GROUP BY topic) s ON s.topic = w.topic""",
            recursive=True,
        ),
        "coherence_cv": _with(_COHERENCE, "SELECT mt AS topic, round(avg(c), 6) AS coherence FROM cosine GROUP BY mt"),
        "coherence_curve": _with(_CURVE, "SELECT k, coherence, k = 4 AS is_recommended FROM curve"),
        "select_k": _with(
            _SELECT_K,
            "SELECT CAST(coalesce((SELECT knee FROM knees), (SELECT k FROM curve ORDER BY coherence DESC, k LIMIT 1)) AS INTEGER) AS k",
        ),
        "word_relevance": _with(
            _FOLDED,
            "SELECT r.word, r.topic AS topic_id, CAST(r.n AS DOUBLE) AS importance, coalesce(c.n, 0) AS word_count FROM ranked r "
            "LEFT JOIN (SELECT word, count(*) AS n FROM words GROUP BY word) c ON c.word = r.word WHERE r.rank <= 25",
        ),
        "term_relevance": _with(
            _EMPIRICAL,
            "SELECT topic, word, round(0.6::DOUBLE * ln(p) + 0.4::DOUBLE * ln(p / pw), 6) AS relevance, round(saliency, 6) AS saliency "
            "FROM scored JOIN sal USING (word)",
        ),
        "topic_distance": _with(_DISTANCES, "SELECT topic_a, topic_b, round(distance, 6) AS distance FROM distances"),
        "topic_centred": _with(
            _DISTANCES + """,
square AS (SELECT topic_a, topic_b, distance * distance AS d FROM distances UNION ALL
  SELECT topic_b, topic_a, distance * distance FROM distances UNION ALL SELECT topic, topic, 0 FROM tot),
line AS (SELECT topic_a AS topic, avg(d) AS m FROM square GROUP BY topic_a)""",
            """SELECT s.topic_a, s.topic_b, round(-(s.d - a.m - b.m + (SELECT avg(m) FROM line)) / 2, 6) AS value
FROM square s JOIN line a ON a.topic = s.topic_a JOIN line b ON b.topic = s.topic_b""",
        ),
        "topic_map": _with(_EMPIRICAL, "SELECT topic, round(total / CAST(n_all AS DOUBLE), 6) AS share FROM tot CROSS JOIN alln"),
        "topic_names": _with(_FOLDED, "SELECT CAST(topic AS VARCHAR) AS topic, upper(word) AS title FROM ranked WHERE rank = 1"),
        "term_cosine_edges": _with(_EDGES, "SELECT topic, src, dst, round(weight, 6) AS weight FROM edges"),
        "inverse_weight": _with(_EDGES, "SELECT topic, src, dst, round(1 / weight, 6) AS weight FROM edges"),
        "node_frequency_rank": _with(
            _VOCAB,
            "SELECT topic, term, round(freq, 6) AS freq, "
            "CAST(row_number() OVER (PARTITION BY topic ORDER BY freq, term) - 1 AS INTEGER) AS rank FROM vocab",
        ),
        "closeness": _with(_closeness(), "SELECT topic, term, round(closeness, 6) AS closeness FROM closeness"),
        "betweenness": _with(
            _betweenness(),
            "SELECT k.topic, k.term, round(coalesce(t.share, 0) / CAST((z.n - 1) * (z.n - 2) AS DOUBLE), 6) AS betweenness "
            "FROM node k LEFT JOIN total t ON t.topic = k.topic AND t.v = k.id JOIN size z ON z.topic = k.topic",
        ),
        "break_cycles": _with(_ACYCLIC, "SELECT topic, word, next_word, n FROM acyclic", recursive=True),
        "topic_story": _with(_STORY, "SELECT topic, word, level FROM story", recursive=True),
        "topic_prompt_payload": _with(
            _EMPIRICAL,
            """SELECT topic, concat('[', string_agg(concat('{"word":"', word, '","p":', CAST(round(p, 6) AS VARCHAR), '}'), ','
  ORDER BY p DESC, word), ']') AS words FROM (SELECT * FROM terms
  QUALIFY row_number() OVER (PARTITION BY topic ORDER BY n DESC, word) <= 25) GROUP BY topic""",
        ),
        "parse_topic_names": _with(
            _POSTS,
            "SELECT post_id, CASE WHEN country = 'de' THEN NULL ELSE coalesce(domain_group, 'none') END AS first_title, "
            "country NOT IN ('de', 'es') AS complete FROM posts",
        ),
        "map_chunks": _with(_POSTS, "SELECT post_id, len(full_text) AS n FROM posts"),
    }
