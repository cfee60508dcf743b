"""DuckDB twins of the registered queries (the correctness oracle).

Each string runs on DuckDB with the test tables registered as views. The
chunk twins do not replay the Python fold: they use the index form of the
packing contract (cumulative piece lengths, next start = number of offsets
more than ``overlap`` behind the end) in a recursive CTE.
"""

from __future__ import annotations

from sifter.functions.text import WS_CLASS

WS = WS_CLASS + "+"


def clean(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '{WS}', ' ', 'g'))"


def clean_ws(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}', ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}|{WS}$', '', 'g')"


def bucket(w: str, dim: int) -> str:
    return f"(('0x' || substr(md5({w}), 1, 8))::BIGINT % {dim})"


CLEAN_DOCS = f"""docs AS (
  SELECT doc_id, source, lang, {clean('text')} AS content FROM documents WHERE text IS NOT NULL)"""


def recursive_chunks_cte(size: int = 500, overlap: int = 80, docs: str = CLEAN_DOCS) -> str:
    """CTEs ``docs`` .. ``rchunks(doc_id, source, lang, chunk_pos, chunk_text)``
    for the recursive chunker over cleaned text (valid while the longest word
    plus the overlap fits in ``size``). Offsets ``p_j`` are the cumulative
    piece lengths; for a start ``s`` the chunk ends at the last offset within
    ``size`` and the next start is the first offset at most ``overlap``
    behind that end (two ASOF joins); the recursion only follows pointers."""
    return f"""{docs},
wl AS (SELECT doc_id, string_split(content, ' ') AS ws FROM docs WHERE content <> ''),
wu AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM wl),
offs AS (
  SELECT doc_id, i AS j, (sum(length(w) + 1) OVER (PARTITION BY doc_id ORDER BY i) - 1)::BIGINT AS p FROM wu
  UNION ALL SELECT doc_id, 0, 0 FROM wl),
nn AS (SELECT doc_id, max(j) AS n FROM offs GROUP BY doc_id),
fe AS (SELECT a.doc_id, a.j AS s, a.p AS ps, b.j AS e, b.p AS pe
       FROM (SELECT *, p + {size} AS lim FROM offs) a ASOF JOIN offs b ON a.doc_id = b.doc_id AND a.lim >= b.p),
gs AS (SELECT a.doc_id, a.j AS e, b.j AS ns
       FROM (SELECT *, p - {overlap} AS lo FROM offs) a ASOF JOIN offs b ON a.doc_id = b.doc_id AND a.lo <= b.p),
step AS (SELECT fe.*, gs.ns FROM fe JOIN gs ON fe.doc_id = gs.doc_id AND fe.e = gs.e),
ch AS (
  SELECT st.doc_id, 0 AS pos, st.ps, st.pe, st.e, st.ns, nn.n FROM step st JOIN nn USING (doc_id) WHERE st.s = 0
  UNION ALL
  SELECT st.doc_id, ch.pos + 1, st.ps, st.pe, st.e, st.ns, ch.n
  FROM ch JOIN step st ON st.doc_id = ch.doc_id AND st.s = ch.ns WHERE ch.e < ch.n),
rchunks AS (
  SELECT ch.doc_id, d.source, d.lang, ch.pos::BIGINT AS chunk_pos,
         trim(substr(d.content, ch.ps + 1, ch.pe - ch.ps)) AS chunk_text
  FROM ch JOIN docs d USING (doc_id))"""


def dense_chunks_cte(size: int = 500, overlap: int = 80) -> str:
    return recursive_chunks_cte(size, overlap) + """,
dchunks AS (SELECT *, row_number() OVER (ORDER BY doc_id, chunk_pos) - 1 AS chunk_id FROM rchunks)"""


def pack_cte(pieces_sql: str, size: int, overlap: int, sep_sql: str, seplen: int, name: str = "packed") -> str:
    """Packing of a list column ``L`` of pieces per ``doc_id`` (from
    ``pieces_sql``) into ``{name}(doc_id, chunk_pos, chunk_text)``."""
    c1 = f"len(list_filter(Q, lambda y: Q[e + 1] - y - {seplen} > {overlap}))"
    c2 = f"len(list_filter(Q, lambda y: Q[e + 2] - y - {seplen} > {size}))"
    ns = f"greatest(s, least(e, greatest({c1}, {c2})))"

    def e_of(s: str) -> str:
        return f"greatest({s} + 1, len(list_filter(Q, lambda y: y - Q[{s} + 1] - {seplen} <= {size})) - 1)"

    return f"""pc AS ({pieces_sql}),
pq AS (SELECT doc_id, L, list_prepend(0, list_transform(range(1, len(L) + 1),
          lambda j: list_sum(list_transform(L[1:j], lambda x: length(x) + {seplen})))) AS Q FROM pc),
pk AS (
  SELECT doc_id, 0 AS s, {e_of('0')} AS e, L, Q FROM pq
  UNION ALL
  SELECT doc_id, {ns}, {e_of(ns)}, L, Q FROM pk WHERE e < len(L)),
{name} AS (
  SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1)::BIGINT AS chunk_pos, chunk_text
  FROM (SELECT doc_id, s, {strip(f'array_to_string(L[s + 1:e], {sep_sql})')} AS chunk_text FROM pk)
  WHERE chunk_text <> '')"""


def _lines_pieces() -> str:
    return ("SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS L "
            "FROM documents WHERE text IS NOT NULL")


def _sentence_pieces() -> str:
    split = f"string_split(regexp_replace(text, '([.!?]){WS}', '\\1' || chr(1), 'g'), chr(1))"
    return (f"SELECT doc_id, list_filter(list_transform({split}, lambda x: {strip('x')}), "
            f"lambda x: x <> '') AS L FROM documents WHERE text IS NOT NULL")


def hashed_vectors(src: str, id_cols: str, text_col: str, dim: int = 64) -> str:
    """Dense float vectors of the hashed encoder, then viewed in double."""
    return f"""SELECT {id_cols}, v, sqrt(list_dot_product(v, v)) AS nrm FROM (
  SELECT {id_cols}, list_transform(cnts, lambda c: (c / sqrt(list_sum(list_transform(cnts, lambda y: y * y))))::FLOAT)::DOUBLE[] AS v
  FROM (SELECT {id_cols}, list_transform(range({dim}), lambda bb: len(list_filter(bs, lambda x: x = bb))) AS cnts
        FROM (SELECT {id_cols}, list_transform(string_split({text_col}, ' '), lambda w: {bucket('w', dim)}) AS bs
              FROM {src} WHERE {text_col} <> '')))"""


QUESTIONS = f"qs AS (SELECT item_id, {clean('text')} AS question FROM benchmark)"


def _knn_chunks(k: int, select: str, where: str = "TRUE", extra_cols: str = "", tie: str = "chunk_id") -> str:
    return f"""WITH RECURSIVE {dense_chunks_cte()}, {QUESTIONS},
qv AS ({hashed_vectors('qs', 'item_id', 'question')}),
cv AS ({hashed_vectors(f'(SELECT * FROM dchunks WHERE {where})', 'chunk_id, doc_id, chunk_pos, source', 'chunk_text')}),
pairs AS (
  SELECT q.item_id, c.chunk_id, c.doc_id, c.chunk_pos, c.source{extra_cols},
         round(1 - list_dot_product(q.v, c.v) / (q.nrm * c.nrm), 12) AS apart, round(apart, 6) + 0.0 AS distance
  FROM qv q, cv c WHERE q.nrm > 0 AND c.nrm > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY apart, {tie}) AS rank FROM pairs)
SELECT {select} FROM ranked WHERE rank <= {k}"""


def _knn_vectors(metric: str) -> str:
    if metric == "cosine":
        d = "1 - list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v)))"
    else:
        d = "list_sum(list_transform(range(1, len(a.v) + 1), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i])))"
    return f"""WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL),
pairs AS (SELECT a.vec_id AS qid, b.vec_id, b.label, round({d}, 12) AS apart, round(apart, 6) + 0.0 AS distance FROM e a, e b),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY apart, vec_id) AS rank FROM pairs)
SELECT qid, rank, vec_id, label, distance FROM ranked WHERE rank <= 5"""


SQL: dict[str, str] = {
    "clean_text": f"SELECT doc_id, {clean('text')} AS content FROM documents",
    "clean_table": f"SELECT doc_id, {clean('text')} AS text, lang, source, n_chars FROM documents",
    "filter_missing_content": """SELECT l.doc_id, l.quality, l.toxic, length(d.text)::BIGINT AS n_chars
        FROM labels l LEFT JOIN documents d USING (doc_id) WHERE d.text IS NOT NULL""",
    "chunk_recursive": f"WITH RECURSIVE {recursive_chunks_cte()} SELECT doc_id, chunk_pos, chunk_text FROM rchunks",
    "chunk_separator": f"WITH RECURSIVE {pack_cte(_lines_pieces(), 1000, 200, 'chr(10)', 1)} SELECT * FROM packed",
    "chunk_separator_no_overlap": f"WITH RECURSIVE {pack_cte(_lines_pieces(), 1000, 0, 'chr(10)', 1)} SELECT * FROM packed",
    "chunk_sentences": f"WITH RECURSIVE {pack_cte(_sentence_pieces(), 1000, 200, 'chr(10) || chr(10)', 2)} SELECT * FROM packed",
    "chunk_tokens": f"""WITH t AS (SELECT doc_id, CASE WHEN {clean_ws('text')} = '' THEN []::VARCHAR[]
                 ELSE string_split({clean_ws('text')}, ' ') END AS toks FROM documents WHERE text IS NOT NULL),
        w AS (SELECT doc_id, toks, unnest(range(0, CASE WHEN len(toks) = 0 THEN 0
                 ELSE 1 + ceil(greatest(len(toks) - 256, 0) / 224)::BIGINT END)) AS j FROM t)
        SELECT doc_id, j::BIGINT AS chunk_pos, array_to_string(toks[j * 224 + 1 : j * 224 + 256], ' ') AS chunk_text FROM w""",
    "chunk_dense_ids": f"WITH RECURSIVE {dense_chunks_cte()} SELECT chunk_id, doc_id, chunk_pos FROM dchunks",
    "chunks_per_document": f"""WITH RECURSIVE {recursive_chunks_cte()}
        SELECT doc_id, count(*) AS n_chunks, max(length(chunk_text))::BIGINT AS max_len FROM rchunks GROUP BY doc_id""",
    "embed_hashed_tf": f"""WITH {CLEAN_DOCS},
        tok AS (SELECT doc_id, unnest(string_split(content, ' ')) AS w FROM docs WHERE content <> ''),
        b AS (SELECT doc_id, {bucket('w', 64)} AS bucket, count(*) AS cnt FROM tok GROUP BY ALL),
        n AS (SELECT doc_id, sqrt(sum(cnt * cnt)) AS nrm FROM b GROUP BY doc_id)
        SELECT doc_id, bucket, cnt, round(((cnt / nrm)::FLOAT)::DOUBLE, 6) AS weight FROM b JOIN n USING (doc_id)""",
    "embed_questions": f"""WITH {QUESTIONS},
        tok AS (SELECT item_id, unnest(string_split(question, ' ')) AS w FROM qs WHERE question <> ''),
        b AS (SELECT item_id, {bucket('w', 64)} AS bucket, count(*) AS cnt FROM tok GROUP BY ALL),
        n AS (SELECT item_id, sqrt(sum(cnt * cnt)) AS nrm FROM b GROUP BY item_id)
        SELECT item_id, bucket, round(((cnt / nrm)::FLOAT)::DOUBLE, 6) AS weight FROM b JOIN n USING (item_id)""",
    "knn_cosine": _knn_chunks(3, "item_id, rank, chunk_id, doc_id, chunk_pos, distance"),
    "knn_l2": _knn_vectors("l2"),
    "knn_vectors_cosine": _knn_vectors("cosine"),
    "knn_topk_sweep": _knn_chunks(4, "item_id, k, rank, chunk_id, distance").replace(
        "SELECT item_id, k, rank, chunk_id, distance FROM ranked WHERE rank <= 4",
        "SELECT item_id, k::BIGINT AS k, rank, chunk_id, distance FROM ranked, (VALUES (2), (3), (4)) kk(k) WHERE rank <= k"),
    "knn_filtered": _knn_chunks(3, "item_id, rank, chunk_id, doc_id, source AS link, distance", "contains(source, 'src1')"),
    "rag_retrieve_top2": _knn_chunks(2, "item_id, rank, chunk_id, doc_id, distance"),
}


# ---------------------------------------------------------------- pages

def unescape(x: str) -> str:
    for ent, ch in (("&quot;", "'\"'"), ("&middot;", "'·'"), ("&copy;", "'©'"), ("&lt;", "'<'"),
                    ("&gt;", "'>'"), ("&#39;", "''''"), ("&nbsp;", "chr(160)"), ("&amp;", "'&'")):
        x = f"replace({x}, '{ent}', {ch})"
    return x


def html_text(x: str) -> str:
    return clean_ws(unescape(f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"))


def resolve(base: str, href: str) -> str:
    return f"""CASE WHEN regexp_matches({href}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {href}
      WHEN starts_with({href}, '//') THEN regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) || ':' || {href}
      WHEN starts_with({href}, '/') THEN regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || {href}
      WHEN starts_with({href}, '?') THEN regexp_extract({base}, '^([^?#]*)', 1) || {href}
      WHEN starts_with({href}, '#') THEN regexp_extract({base}, '^([^#]*)', 1) || {href}
      ELSE regexp_extract({base}, '^([^?#]*/)', 1) || {href} END"""


NAV = """nv AS (SELECT page_id, url, nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS lang,
        regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a href="([^"]*)"', 1) AS hrefs FROM pages),
nl AS (SELECT page_id, url, lang, unnest(hrefs) AS href, unnest(range(len(hrefs))) AS pos FROM nv)"""



def _stop_list() -> str:
    from sifter.operators.keywords import STOP_WORDS
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS) + "]"


def kw_tokens(x: str) -> str:
    return (f"list_filter(regexp_extract_all(lower({x}), '\\p{{L}}+'), "
            f"lambda t: length(t) >= 2 AND NOT list_contains({_stop_list()}, t))")


KEYWORDS = f"""kt AS (SELECT doc_id, unnest({kw_tokens('text')}) AS keyword FROM documents),
kc AS (SELECT doc_id, keyword, count(*) AS cnt FROM kt GROUP BY ALL),
kw AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY cnt DESC, keyword) AS rank FROM kc)
       WHERE rank <= 10)"""


def _sentences_cte() -> str:
    split = f"string_split(regexp_replace(text, '([.!?]){WS}', '\\1' || chr(1), 'g'), chr(1))"
    return f"""sl AS (SELECT doc_id, list_filter(list_transform({split}, lambda x: {strip('x')}), lambda x: x <> '') AS L
       FROM documents WHERE text IS NOT NULL),
se AS (SELECT doc_id, unnest(L) AS sentence, unnest(range(len(L))) AS spos FROM sl)"""


def _page_keywords() -> str:
    """pkeys (doc_id, keywords) and psum (doc_id, summary) of the pages' article texts."""
    text = html_text("regexp_extract(html, '(?s)<article>(.*)</article>', 1)")
    split = f"string_split(regexp_replace(text, '([.!?]){WS}', '\\1' || chr(1), 'g'), chr(1))"
    return f"""pdoc AS (SELECT page_id AS doc_id, {text} AS text FROM pages WHERE regexp_matches(html, '<article[ >]')),
        pkt AS (SELECT doc_id, unnest({kw_tokens('text')}) AS keyword FROM pdoc),
        pkc AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY cnt DESC, keyword) AS rank
                FROM (SELECT doc_id, keyword, count(*) AS cnt FROM pkt GROUP BY ALL)),
        pkeys AS (SELECT pdoc.doc_id, coalesce(string_agg(keyword, ' ' ORDER BY rank), '') AS keywords
                  FROM pdoc LEFT JOIN pkc ON pkc.doc_id = pdoc.doc_id AND rank <= 5 GROUP BY pdoc.doc_id),
        psl AS (SELECT doc_id, list_filter(list_transform({split}, lambda x: {strip('x')}), lambda x: x <> '') AS L FROM pdoc),
        pse AS (SELECT doc_id, unnest(L) AS sentence, unnest(range(len(L))) AS spos FROM psl),
        ptk AS (SELECT doc_id, spos, unnest(CASE WHEN len(tl) = 0 THEN [NULL] ELSE tl END) AS keyword
                FROM (SELECT doc_id, spos, {kw_tokens('sentence')} AS tl FROM pse)),
        psc AS (SELECT ptk.doc_id, ptk.spos, coalesce(sum(cnt), 0) / greatest(count(ptk.keyword), 1) AS score
                FROM ptk LEFT JOIN pkc ON ptk.doc_id = pkc.doc_id AND ptk.keyword = pkc.keyword AND rank <= 10 GROUP BY ALL),
        psb AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, spos) AS r FROM psc),
        psum AS (SELECT doc_id, string_agg(sentence, ' ' ORDER BY spos) AS summary FROM psb JOIN pse USING (doc_id, spos) WHERE r <= 2 GROUP BY doc_id)"""


SQL.update({
    "extract_page_text": f"""WITH a AS (SELECT page_id, url, regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS inr,
            regexp_matches(html, '<article[ >]') AS has FROM pages)
        SELECT page_id, url, {html_text('inr')} AS content FROM a WHERE has""",
    "extract_links": f"WITH {NAV} SELECT page_id, pos, href, {resolve('url', 'href')} AS link FROM nl",
    "extract_sublinks": """WITH u AS (SELECT page_id, regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1) AS n FROM pages),
        h AS (SELECT page_id, regexp_extract_all(n, '<li>\\s*<a href="([^"]*)"', 1) AS hrefs FROM u)
        SELECT page_id, unnest(range(len(hrefs))) AS pos, unnest(hrefs) AS href FROM h""",
    "extract_all_by_class": f"""WITH d AS (SELECT page_id, regexp_extract_all(html, '(?s)<div class="ad">(.*?)</div>', 1) AS ads FROM pages),
        u AS (SELECT page_id, unnest(ads) AS a, unnest(range(len(ads))) AS pos FROM d)
        SELECT page_id, pos, {html_text('a')} AS text FROM u""",
    "filter_links_by_domain": f"""WITH {NAV}, r AS (SELECT page_id, pos, {resolve('url', 'href')} AS link FROM nl)
        SELECT * FROM r WHERE contains(link, '.example.com')""",
    "distinct_links_ordered": f"""WITH {NAV}, r AS (SELECT href, page_id AS first_page, pos AS first_pos,
            row_number() OVER (PARTITION BY href ORDER BY page_id, pos) AS rn, count(*) OVER (PARTITION BY href) AS n FROM nl)
        SELECT href, first_page, first_pos, n FROM r WHERE rn = 1""",
    "new_links_anti": f"""WITH {NAV}
        SELECT DISTINCT href FROM nl WHERE lang IS DISTINCT FROM 'en'
        AND href NOT IN (SELECT href FROM nl WHERE lang = 'en')""",
    "link_union_distinct": f"""WITH {NAV}, u AS (SELECT 0 AS list, page_id, pos, href FROM nl WHERE lang = 'fr'
            UNION ALL SELECT 1, page_id, pos, href FROM nl),
        r AS (SELECT *, row_number() OVER (PARTITION BY href ORDER BY list, page_id, pos) AS rn FROM u)
        SELECT href, list::BIGINT AS first_list, page_id AS first_page, pos AS first_pos FROM r WHERE rn = 1""",
    "page_ids": """SELECT row_number() OVER (ORDER BY page_id) - 1 AS id, page_id, url FROM pages
        WHERE regexp_matches(html, '<article[ >]')""",
    "article_records": f"""WITH {_page_keywords()}, a AS (SELECT page_id, url, html,
            regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS inr,
            regexp_matches(html, '<article[ >]') AS has,
            regexp_extract_all(html, '<img[^>]*[ ]src="([^"]*)"', 1) AS imgs FROM pages)
        SELECT page_id,
               CASE WHEN regexp_matches(html, '<title>') THEN {html_text("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} END AS title,
               regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS source,
               CASE WHEN has THEN md5({html_text('inr')}) END AS text_md5, keywords, md5(summary) AS summary_md5,
               len(imgs)::BIGINT AS n_images, imgs[1] AS top_image,
               strftime(TRY_CAST(nullif(regexp_extract(html, '<meta property="article:published_time" content="([^"]*)"', 1), '')
                 AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS published_date
        FROM a LEFT JOIN pkeys ON pkeys.doc_id = page_id LEFT JOIN psum ON psum.doc_id = page_id""",
    "article_per_author": """SELECT doc_id, unnest(CASE WHEN lang = 'fr' THEN [source, lang]
        WHEN lang = 'en' THEN [source] ELSE []::VARCHAR[] END) AS author FROM documents""",
    "keywords_topn": f"WITH {KEYWORDS} SELECT doc_id, rank, keyword, cnt FROM kw",
    "summary_topn": f"""WITH {KEYWORDS}, {_sentences_cte()},
        tk AS (SELECT doc_id, spos, unnest(CASE WHEN len(tl) = 0 THEN [NULL] ELSE tl END) AS keyword
               FROM (SELECT doc_id, spos, {kw_tokens('sentence')} AS tl FROM se)),
        sc AS (SELECT tk.doc_id, tk.spos, coalesce(sum(kw.cnt), 0) / greatest(count(tk.keyword), 1) AS score
               FROM tk LEFT JOIN kw ON tk.doc_id = kw.doc_id AND tk.keyword = kw.keyword GROUP BY ALL),
        best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, spos) AS r FROM sc)
                 WHERE r <= 5)
        SELECT b.doc_id, string_agg(se.sentence, ' ' ORDER BY se.spos) AS summary
        FROM best b JOIN se USING (doc_id, spos) GROUP BY b.doc_id""",
    "page_counter": f"""WITH d AS (SELECT doc_id, list_filter(CASE WHEN {clean_ws('text')} = '' THEN []::VARCHAR[]
            ELSE string_split({clean_ws('text')}, ' ') END, lambda x: regexp_matches(x, '^[0-9]+$')) AS d FROM documents)
        SELECT doc_id, TRY_CAST(d[1] AS BIGINT) AS current_page, TRY_CAST(d[2] AS BIGINT) AS max_page FROM d WHERE len(d) > 0""",
    "search_urls": f"""WITH t AS (SELECT item_id, CASE WHEN {clean_ws('text')} = '' THEN []::VARCHAR[]
            ELSE string_split({clean_ws('text')}, ' ') END AS w FROM benchmark),
        p AS (SELECT item_id, replace(replace(replace(url_encode(array_to_string(w[1:3], ' ')), '%20', '+'), '~', '%7E'), '%2A', '*') AS token,
                     unnest(range(1, least(floor(len(w) / 5)::BIGINT, 10))) AS page FROM t)
        SELECT item_id, page, 'https://search.example.org/search?q=' || token || '&limit=10&page=' || page AS url FROM p""",
})


# ---------------------------------------------------------------- RAG and evaluation

def sql_lit(s: str) -> str:
    parts = ["'" + p.replace("'", "''") + "'" for p in s.split("\n")]
    return " || chr(10) || ".join(parts)


def prompt_sql(context: str, question: str) -> str:
    from sifter.operators.rag import DEFAULT_TEMPLATE, template_parts
    cols = {"context": context, "question": question}
    out = [sql_lit(v) if kind == "lit" else f"coalesce({cols[v]}, '')" for kind, v in template_parts(DEFAULT_TEMPLATE)]
    return "(" + " || ".join(out) + ")"


def first_words(x: str, n: int = 256) -> str:
    return f"array_to_string(CASE WHEN {clean_ws(x)} = '' THEN []::VARCHAR[] ELSE string_split({clean_ws(x)}, ' ') END[1:{n}], ' ')"


def n_words(x: str) -> str:
    return f"(CASE WHEN {clean_ws(x)} = '' THEN 0 ELSE len(string_split({clean_ws(x)}, ' ')) END)::BIGINT"


def knn_ctes(p: str, qsrc: str, qid: str, qtext: str, dim: int, k: int) -> str:
    """``{p}top(qid, chunk_id, doc_id, chunk_text, distance, rank)`` over ``dchunks``."""
    return f"""{p}qv AS ({hashed_vectors(qsrc, qid, qtext, dim)}),
{p}cv AS ({hashed_vectors('dchunks', 'chunk_id, doc_id, chunk_text', 'chunk_text', dim)}),
{p}top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY apart, chunk_id) AS rank FROM (
    SELECT q.{qid} AS qid, c.chunk_id, c.doc_id, c.chunk_text,
           round(1 - list_dot_product(q.v, c.v) / (q.nrm * c.nrm), 12) AS apart, round(apart, 6) + 0.0 AS distance
    FROM {p}qv q, {p}cv c WHERE q.nrm > 0 AND c.nrm > 0)) WHERE rank <= {k})"""


SPOKEN = """spoken AS (SELECT conv_id, turn, role, text, count(*) OVER w AS n_prev,
        md5(coalesce(string_agg(coalesce(role, '') || ': ' || coalesce(text, ''), chr(10)) OVER w, '')) AS history_md5
    FROM (SELECT conv_id, turn, role, CASE WHEN role = 'user' AND (conv_id + turn) % 7 = 3 THEN 'exit'
                 WHEN role = 'user' AND (conv_id + turn) % 7 = 5 THEN ' Quit' ELSE text END AS text FROM conversations)
    WHERE NOT (role = 'user' AND text IN ('exit', 'quit', 'q'))
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def ctx_cte(name: str, top: str, keys: str = "qid") -> str:
    return f"""{name} AS (SELECT {keys}, string_agg(chunk_text, chr(10) || chr(10) ORDER BY rank) AS context,
    count(*) AS n_sources, arg_min(chunk_text, rank) AS top1 FROM {top} GROUP BY {keys})"""


def score_ctes(src: str, a: str, b: str, dim: int, out: str) -> str:
    """CTE ``{out}`` = ``src`` plus ``score``: cosine distance of the hashed
    vectors of the cleaned texts ``a`` and ``b`` (null when either has no
    token), rounded like the Spark side. Vectors are built in stages so no
    lambda re-expands another."""
    def toks(x):
        return f"CASE WHEN {x} = '' THEN []::VARCHAR[] ELSE string_split({x}, ' ') END"
    return f"""{out}_1 AS (SELECT *, {clean(a)} AS _ca, {clean(b)} AS _cb FROM {src}),
{out}_2 AS (SELECT *, list_transform({toks('_ca')}, lambda w: {bucket('w', dim)}) AS _ba,
                      list_transform({toks('_cb')}, lambda w: {bucket('w', dim)}) AS _bb FROM {out}_1),
{out}_3 AS (SELECT *, list_transform(range({dim}), lambda bb: len(list_filter(_ba, lambda y: y = bb))) AS _na,
                      list_transform(range({dim}), lambda bb: len(list_filter(_bb, lambda y: y = bb))) AS _nb FROM {out}_2),
{out}_4 AS (SELECT *, sqrt(list_sum(list_transform(_na, lambda z: z * z))) AS _sa,
                      sqrt(list_sum(list_transform(_nb, lambda z: z * z))) AS _sb FROM {out}_3),
{out}_5 AS (SELECT *, list_transform(_na, lambda c: (c / _sa)::FLOAT)::DOUBLE[] AS _va,
                      list_transform(_nb, lambda c: (c / _sb)::FLOAT)::DOUBLE[] AS _vb FROM {out}_4),
{out} AS (SELECT * EXCLUDE (_ca, _cb, _ba, _bb, _na, _nb, _sa, _sb, _va, _vb),
    round(1 - list_dot_product(_va, _vb) / (sqrt(list_dot_product(_va, _va)) * sqrt(list_dot_product(_vb, _vb))), 6) + 0.0 AS score
    FROM {out}_5)"""


QA = """qa AS (SELECT conv_id, turn, question, reference, conv_id || ':' || turn AS qid FROM (
    SELECT conv_id, turn, role, text AS question, lead(role) OVER w AS nrole, lead(text) OVER w AS reference
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND nrole = 'assistant'),
qaq AS (SELECT qid, """ + clean("question") + """ AS question FROM qa)"""


def _grid_sql(dims=(64, 128, 256), ks=(2, 3, 4)) -> str:
    parts, ctes = [], []
    kmax = max(ks)
    kvals = ", ".join(f"({k})" for k in ks)
    for d in dims:
        ctes.append(knn_ctes(f"g{d}", "qaq", "qid", "question", d, kmax))
        ctes.append(f"""g{d}k AS (SELECT t.*, kk.k FROM g{d}top t, (VALUES {kvals}) kk(k) WHERE t.rank <= kk.k)""")
        ctes.append(ctx_cte(f"g{d}c", f"g{d}k", "qid, k"))
        sel = []
        for llm, ans in (("extractive/top1", first_words("top1")), ("extractive/lead", first_words("context"))):
            sel.append(f"""SELECT qa.conv_id, qa.turn, qa.qid, qa.question, '{llm}' AS llm, 'hash{d}' AS transformer,
                c.k::BIGINT AS k, {ans} AS response, qa.reference, c.context FROM g{d}c c JOIN qa USING (qid)""")
        ctes.append(f"g{d}r AS (" + " UNION ALL ".join(sel) + ")")
        ctes.append(score_ctes(f"g{d}r", "response", "reference", d, f"g{d}s"))
        parts.append(f"SELECT * FROM g{d}s")
    return (f"WITH RECURSIVE {dense_chunks_cte()}, {QA}, " + ",\n".join(ctes) +
            ",\ngr AS (" + "\nUNION ALL\n".join(parts) + ")")


def grid_with_scores() -> str:
    return _grid_sql()


def relabel(x: str) -> str:
    from sifter.plans.rag import RELABEL_RULES
    for pat, rep in RELABEL_RULES:
        x = f"regexp_replace({x}, '{pat}', '{rep}', 'g')"
    return x


_BQ = f"WITH RECURSIVE {dense_chunks_cte()}, {QUESTIONS}, {knn_ctes('b', 'qs', 'item_id', 'question', 64, 2)}, {ctx_cte('bc', 'btop')}"
_BQ3 = f"WITH RECURSIVE {dense_chunks_cte()}, {QUESTIONS}, {knn_ctes('b', 'qs', 'item_id', 'question', 64, 3)}, {ctx_cte('bc', 'btop')}"
_GRID_MEANS = grid_with_scores() + """, gm AS (SELECT llm, transformer, k, round(avg(score), 6) AS mean_score FROM gr GROUP BY ALL)"""

SQL.update({
    "context_assembly": _BQ + " SELECT qid AS item_id, context, n_sources FROM bc",
    "prompt_fill": _BQ + f" SELECT qs.item_id, {prompt_sql('bc.context', 'qs.question')} AS prompt FROM qs JOIN bc ON bc.qid = qs.item_id",
    "generate_answers": _BQ + f" SELECT item_id, coalesce({first_words('top1')}, '') AS answer FROM qs LEFT JOIN bc ON bc.qid = qs.item_id",
    "rag_batch": _BQ + f""" SELECT qs.item_id, {n_words(prompt_sql("coalesce(bc.context, '')", 'qs.question'))} AS prompt_tokens,
        coalesce({first_words('bc.context')}, '') AS answer FROM qs LEFT JOIN bc ON bc.qid = qs.item_id""",
    "rag_with_sources": _BQ3 + f""" SELECT t.qid AS item_id, t.rank AS source_rank, t.chunk_id, t.doc_id,
        {first_words('bc.top1')} AS answer FROM btop t JOIN bc USING (qid)""",
    "truncated_prompts": _BQ + f""", pr AS (SELECT item_id, {prompt_sql("coalesce(bc.context, '')", 'qs.question')} AS p FROM qs LEFT JOIN bc ON bc.qid = qs.item_id)
        SELECT item_id, md5({first_words('p', 220)}) AS prompt_md5, {first_words('p', 64)} AS answer FROM pr""",
    "split_failures": _BQ + f""", pr AS (SELECT qs.item_id, {n_words(prompt_sql('bc.context', 'qs.question'))} AS pt,
        {n_words(first_words('bc.context'))} AS aw FROM qs JOIN bc ON bc.qid = qs.item_id)
        SELECT item_id, CASE WHEN pt <= 220 THEN 'ok' ELSE 'failed' END AS status, CASE WHEN pt <= 220 THEN aw ELSE pt END AS n FROM pr""",
    "chat_history_sizes": """SELECT conv_id, turn, count(*) OVER w AS n_prev, coalesce(sum(length(text)) OVER w, 0)::BIGINT AS prev_chars,
        lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_role FROM conversations
        WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "chat_history_window": f"WITH {SPOKEN} SELECT conv_id, turn, n_prev, history_md5 FROM spoken",
    "score_answers": f"WITH {QA}, {score_ctes('qa', 'question', 'reference', 64, 'sq')} SELECT conv_id, turn, score FROM sq",
    "evaluate_qa": f"""WITH RECURSIVE {dense_chunks_cte()}, {QA}, {knn_ctes('e', 'qaq', 'qid', 'question', 64, 2)}, {ctx_cte('ec', 'etop')},
        ea AS (SELECT qa.conv_id, qa.turn, qa.reference, {first_words('ec.context')} AS answer FROM qa JOIN ec USING (qid)),
        {score_ctes('ea', 'answer', 'reference', 64, 'es')}
        SELECT conv_id, turn, answer, score FROM es""",
    "benchmark_grid": grid_with_scores() + " SELECT conv_id, turn, llm, transformer, k, response, score FROM gr",
    "benchmark_counts": grid_with_scores() + f""" SELECT llm, transformer, k, count(*) AS attempts, count(*) FILTER (pt <= 220) AS ok,
        count(*) FILTER (pt > 220) AS failed FROM (SELECT *, {n_words(prompt_sql('context', 'question'))} AS pt FROM gr) GROUP BY ALL""",
    "mean_time_by_config": grid_with_scores() + " SELECT llm, transformer, k, count(*) AS answers, true AS timed FROM gr GROUP BY ALL",
    "mean_score_by_config": _GRID_MEANS + " SELECT * FROM gm",
    "sorted_means": _GRID_MEANS + " SELECT * FROM gm ORDER BY mean_score, llm, transformer, k",
    "relabel_all_strings": grid_with_scores() + f""" SELECT {relabel('qid')} AS qid, {relabel('llm')} AS llm,
        {relabel('transformer')} AS transformer, k, score FROM gr""",
    "exclude_label": grid_with_scores() + f""", rl AS (SELECT {relabel('qid')} AS qid, {relabel('llm')} AS llm,
        {relabel('transformer')} AS transformer, k, score FROM gr) SELECT * FROM rl WHERE llm IS DISTINCT FROM 'lead'""",
    "config_report": grid_with_scores() + f""", rl AS (SELECT {relabel('llm')} AS llm, {relabel('transformer')} AS transformer, k, score FROM gr),
        gm AS (SELECT llm, transformer, k, round(avg(score), 6) AS mean_score FROM rl GROUP BY ALL)
        SELECT llm, transformer, k, printf('average score of %s with %s at k=%d: %.6f', llm, transformer, k, mean_score) AS report FROM gm""",
    "preview_document": "SELECT doc_id, source, text FROM documents ORDER BY doc_id LIMIT 1",
    "limit_questions": f"SELECT item_id, {clean('text')} AS question FROM benchmark ORDER BY item_id LIMIT 100",
})


# ---------------------------------------------------------------- sources and collections

def page_text(x: str) -> str:
    """Whole-page text: script/style blocks and tags dropped, entities
    unescaped, whitespace collapsed."""
    y = f"regexp_replace({x}, '(?s)<script[^>]*>.*?</script>', ' ', 'g')"
    y = f"regexp_replace({y}, '(?s)<style[^>]*>.*?</style>', ' ', 'g')"
    y = f"regexp_replace({y}, '(?s)<!--.*?-->', ' ', 'g')"
    return html_text(y)


def _lines_of(src: str) -> str:
    return (f"SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS L "
            f"FROM ({src}) WHERE text IS NOT NULL")


_CORPUS = f"""SELECT 'txt:' || doc_id AS doc_id, text FROM documents
  UNION ALL SELECT 'html:' || page_id, {html_text("regexp_extract(html, '(?s)<article>(.*)</article>', 1)")} FROM pages
    WHERE regexp_matches(html, '<article[ >]')
  UNION ALL SELECT 'csv:' || conv_id, string_agg(concat_ws(' ', role, text), chr(10) ORDER BY turn) FROM conversations GROUP BY conv_id"""

_GRID_CELLS = grid_with_scores() + """, gm AS (SELECT llm, transformer, k, count(*) AS rows, round(avg(score), 6) AS mean_score,
    1::BIGINT AS files_ids FROM gr GROUP BY ALL)"""

SQL.update({
    "scan_csv": "SELECT doc_id AS id, source AS link, text AS content FROM documents",
    "scan_csv_with_index": "SELECT row_number() OVER (ORDER BY item_id) - 1 AS _index, item_id, text FROM benchmark",
    "scan_csv_skip_bad": """SELECT doc_id, lang, md5(translate(text, chr(34) || chr(10) || chr(13), '   ')) AS line_md5 FROM documents
        WHERE NOT contains(text, ',') AND doc_id % 3 <> 0""",
    "link_lines_roundtrip": f"WITH {NAV} SELECT {resolve('url', 'href')} AS link, count(*) AS n FROM nl GROUP BY ALL",
    "benchmark_sink": _GRID_CELLS + " SELECT * FROM gm",
    "union_result_files": grid_with_scores() + " SELECT k, count(*) AS rows, round(avg(score), 6) AS mean_score FROM gr GROUP BY k",
    "scan_by_kind": f"SELECT page_id, 'html' AS kind, md5({page_text('html')}) AS text_md5, NULL::VARCHAR AS error FROM pages",
    "binary_pages": """SELECT page_id, len(string_split(html, '<p>'))::BIGINT AS n_pages,
        length(replace(html, '<p>', ''))::BIGINT AS n_chars,
        md5(array_to_string(list_sort(list_transform(string_split(regexp_replace(html, '[\r\n]', ' ', 'g'), '<p>'), lambda x: md5(x))), ',')) AS units_md5 FROM pages""",
    "union_drifting_files": "SELECT doc_id, source, CASE WHEN lang = 'en' THEN NULL ELSE n_chars END AS n_chars FROM documents",
    "load_documents": f"""SELECT page_id, NULL::BIGINT AS conv_id, NULL::BIGINT AS turn, 1::BIGINT AS n_meta, chunk_pos, text_md5 FROM (
        WITH RECURSIVE {pack_cte(f"SELECT page_id AS doc_id, [{page_text('html')}] AS L FROM pages", 1000, 200, 'chr(10)', 1)}
        SELECT doc_id AS page_id, chunk_pos, md5(chunk_text) AS text_md5 FROM packed)
        UNION ALL SELECT NULL, conv_id, turn, 2, chunk_pos, text_md5 FROM (
        WITH RECURSIVE {pack_cte("SELECT conv_id * 1000000 + turn AS doc_id, list_filter(string_split(concat_ws(' ', nullif(role, ''), nullif(text, '')), chr(10)), lambda x: x <> '') AS L FROM conversations", 1000, 200, 'chr(10)', 1)}
        SELECT doc_id // 1000000 AS conv_id, doc_id % 1000000 AS turn, chunk_pos, md5(chunk_text) AS text_md5 FROM packed)""",
    "rows_to_documents": """SELECT conv_id, md5(string_agg(concat_ws(' ', turn::VARCHAR, role, text), chr(10) ORDER BY turn)) AS text_md5,
        count(*) AS n_rows FROM conversations GROUP BY conv_id""",
    "text_to_documents": f"""WITH RECURSIVE {pack_cte(_lines_pieces(), 1000, 200, 'chr(10)', 1)}
        SELECT doc_id, chunk_pos, 'local' AS source, md5(chunk_text) AS text_md5 FROM packed""",
    "corpus_union": f"""WITH RECURSIVE {pack_cte(_lines_of(_CORPUS), 1000, 200, 'chr(10)', 1)}
        SELECT split_part(doc_id, ':', 1) AS kind, split_part(doc_id, ':', 2)::BIGINT AS key, chunk_pos,
               md5(chunk_text) AS text_md5 FROM packed""",
    "collection_add": f"""WITH RECURSIVE {dense_chunks_cte()}, cv AS ({hashed_vectors('dchunks', 'chunk_id', 'chunk_text')})
        SELECT d.chunk_id, source AS link, md5(chunk_text) AS text_md5, round(list_sum(v), 4) AS vector_sum FROM dchunks d LEFT JOIN cv USING (chunk_id)""",
    "collection_roundtrip": _knn_chunks(3, "item_id, rank, chunk_id, distance", "contains(source, 'src1')",
                                        tie="chunk_id::VARCHAR"),
    "chunk_link_join": f"WITH RECURSIVE {dense_chunks_cte()} SELECT chunk_id, doc_id, source AS link FROM dchunks",
    "metadata_scalars": """SELECT doc_id, 'source' AS key, source AS value FROM documents
        UNION ALL SELECT doc_id, 'lang', lang FROM documents
        UNION ALL SELECT doc_id, 'n_chars', n_chars::VARCHAR FROM documents""",
})


# ---------------------------------------------------------------- streams

_PAGE_DOCS = f"""docs AS (SELECT page_id AS doc_id, url AS source, NULL AS lang,
    {clean(html_text("regexp_extract(html, '(?s)<article>(.*)</article>', 1)"))} AS content
    FROM pages WHERE regexp_matches(html, '<article[ >]'))"""

SQL.update({
    "chat_stream": SQL["chat_history_window"],
    "chat_answers_stream": f"""WITH RECURSIVE {dense_chunks_cte()}, {SPOKEN},
        asked AS (SELECT *, conv_id || ':' || turn AS qid, {clean('text')} AS question FROM spoken WHERE role = 'user'),
        {knn_ctes('s', 'asked', 'qid', 'question', 64, 2)}, {ctx_cte('sc', 'stop')}
        , told AS (SELECT conv_id, turn, text, coalesce({first_words('top1')}, '') AS answer FROM asked LEFT JOIN sc USING (qid))
        SELECT conv_id, turn, answer, md5(coalesce(string_agg('user: ' || coalesce(text, '') || chr(10) || 'assistant: ' || answer, chr(10)) OVER (
            PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '')) AS history_md5 FROM told""",
    "link_dedup_stream": f"WITH {NAV} SELECT DISTINCT href FROM nl",
    "ingest_stream": f"""WITH RECURSIVE {recursive_chunks_cte(500, 80, _PAGE_DOCS)}
        SELECT doc_id AS page_id, chunk_pos, source AS link, md5(chunk_text) AS text_md5 FROM rchunks""",
})


# ---------------------------------------------------------------- scalar functions

def _words_sql(x: str) -> str:
    return f"(CASE WHEN {clean_ws(x)} = '' THEN []::VARCHAR[] ELSE string_split({clean_ws(x)}, ' ') END)"


SQL.update({
    "scalar_strings": f"""SELECT doc_id, md5(lower(text)) AS lower_md5,
        len({_words_sql('text')})::BIGINT AS n_words, {_words_sql('text')}[1] AS first_word,
        length(trim(text))::BIGINT AS trimmed_len, length(replace(text, chr(10), ''))::BIGINT AS no_newline_len,
        length(regexp_replace(text, '[0-9]', '', 'g'))::BIGINT AS no_digit_len,
        contains(lower(text), 'the') AS has_the, instr(text, 'e')::BIGINT AS first_e,
        coalesce(regexp_matches({_words_sql('text')}[1], '^[0-9]+$'), false) AS starts_with_number,
        doc_id::VARCHAR AS id_str, lang || '-' || doc_id AS label, length(text)::BIGINT AS n_chars FROM documents""",
    "scalar_misc": """SELECT vec_id, (label + 1)::BIGINT AS seq_len, least(label, 3)::BIGINT AS least3,
        label::BIGINT AS nested_label, label::BIGINT AS map_label, CASE WHEN label > 5 THEN 'hi' ELSE 'lo' END AS band,
        round(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]), 6) AS sq_norm FROM embeddings""",
    "url_hosts": """SELECT page_id, nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)', 1), '') AS host,
        ends_with(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)', 1), '.example.com') AS in_site FROM pages""",
})


SQL["knn_ann_exhaustive"] = _knn_vectors("cosine")
SQL["weighted_sample"] = """WITH c AS (SELECT source, doc_id, n_chars,
    -ln((('0x' || substr(md5('17:0:' || source || ':' || doc_id || ':' || n_chars), 1, 13))::BIGINT + 1) / 4503599627370496.0::DOUBLE) / n_chars AS key
    FROM documents WHERE n_chars > 0)
    SELECT source, 0::BIGINT AS draw, arg_min(doc_id, key) AS doc_id, arg_min(n_chars, key) AS n_chars FROM c GROUP BY source"""
SQL["knn_ann_recall"] = """SELECT sum(least(5, n))::BIGINT AS neighbours, true AS nine_in_ten, true AS exact_distances, true AS a_quarter_at_most
    FROM (SELECT count(*) OVER () AS n FROM embeddings WHERE embedding IS NOT NULL)"""

SQL["knn_pruned"] = SQL["knn_vectors_cosine"]
