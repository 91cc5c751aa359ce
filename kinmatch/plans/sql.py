"""The registered queries as plain SQL over the test tables, written without regard to scale.

Common table expressions are kept by name with what they build on; :func:`query` puts together
those a statement needs.
"""

from __future__ import annotations

from ..functions.text import ABBREVIATIONS

_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: tuple[str, ...], body: str) -> None:
    _CTES[name] = (needs, body)


def query(statement: str, *roots: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for need in _CTES[name][0]:
                visit(need)
            if name not in order:
                order.append(name)

    for root in roots:
        visit(root)
    if not order:
        return statement
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][1]})" for n in order) + "\n" + statement


SPACE = r"\s\p{Z}\x{85}\x0b\x1c-\x1f"


def squash(x: str) -> str:
    return (
        f"trim(regexp_replace(replace(lower(coalesce({x}, '')), '&', ' and '), '[[:punct:]{SPACE}]+', ' ', 'g'))"
    )


def normalize(x: str) -> str:
    cases = " ".join(f"WHEN '{long}' THEN '{brief}'" for long, brief in ABBREVIATIONS.items())
    return f"array_to_string(list_transform(string_split({squash(x)}, ' '), lambda t: CASE t {cases} ELSE t END), ' ')"


def country(x: str) -> str:
    return f"lower(regexp_replace(coalesce({x}, ''), '^[{SPACE}]+|[{SPACE}]+$', '', 'g'))"


def toks(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[{SPACE}]+'), lambda t: t <> '')"


# ---------------------------------------------------------------- fixtures

_CORE = "p_name || ' ' || replace(lower(p_brand), '#', ' ') || ' ' || (p_partkey % 211)"
cte(
    "p_base",
    (),
    f"""SELECT p_partkey AS k, p_type, {_CORE} AS core,
    p_size || ' ' || lower(p_type) || ' ' || (p_partkey % 503) AS stub,
    CASE WHEN p_partkey % 20 < 9 THEN 'US' WHEN p_partkey % 20 < 17 THEN 'India' ELSE 'France' END AS country
    FROM part""",
)
cte(
    "p_raw",
    ("p_base",),
    """SELECT 'S1-' || k AS entity_id, 1 AS src,
    core || ' ' || CASE k % 4 WHEN 0 THEN 'Corporation' WHEN 1 THEN 'Private Limited' WHEN 2 THEN '& Company' ELSE 'Incorporated' END AS business_name,
    stub || ' Road' AS business_address, country, k AS ord FROM p_base
    UNION ALL SELECT 'S2-' || k, 2,
    upper(core) || ' ' || CASE k % 4 WHEN 0 THEN 'Corp.' WHEN 1 THEN 'Pvt. Ltd.' WHEN 2 THEN 'and Co' ELSE 'Inc' END,
    stub || ' Rd.', country, k FROM p_base WHERE p_type <> 'PROMO'
    UNION ALL SELECT 'S3-' || k, 3,
    split_part(core, ' ', 2) || ' ' || split_part(core, ' ', 1) || ' ' || split_part(core, ' ', 3) || ' ' || split_part(core, ' ', 4) || ' trading',
    CASE WHEN p_type = 'LARGE' THEN '' ELSE stub END, country, k FROM p_base WHERE p_type IN ('SMALL', 'MEDIUM', 'LARGE')""",
)
cte(
    "d_raw",
    (),
    """SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS entity_id, (doc_id % 3 + 1)::INT AS src,
    array_to_string(w[1:6], ' ') AS business_name, array_to_string(w[7:], ' ') AS business_address,
    lang AS country, doc_id AS ord
    FROM (SELECT doc_id, lang, string_split(replace(text, chr(10), ' '), ' ') AS w FROM documents)""",
)
for _f in ("p", "d"):
    cte(
        f"{_f}_rec",
        (f"{_f}_raw",),
        f"""SELECT entity_id, src, {normalize('business_name')} AS nn, {normalize('business_address')} AS na,
        {country('country')} AS cc, ord FROM {_f}_raw""",
    )
cte(
    "p_truth_raw",
    (),
    """SELECT 'S1-' || p_partkey AS source1_entity_id,
    CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN 'S2-' || p_partkey || ' , S3-' || p_partkey || ','
    WHEN p_type = 'PROMO' THEN ' ' ELSE ' S2-' || p_partkey END AS matched_entity_ids FROM part""",
)
cte(
    "p_truth",
    ("p_truth_raw",),
    """SELECT trim(source1_entity_id) AS s1_id, list_sort(list_distinct(list_filter(list_transform(
    string_split(matched_entity_ids, ','), lambda x: trim(x)), lambda x: x <> ''))) AS truth FROM p_truth_raw""",
)
cte("p_truth_pairs", ("p_truth",), "SELECT s1_id, unnest(truth) AS c_id FROM p_truth")

# ---------------------------------------------------------------- similarity


def word_terms(text: str) -> str:
    return f"""(SELECT list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))
    FROM (SELECT regexp_extract_all({text}, '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t))"""


def char_terms(text: str) -> str:
    return f"""flatten(list_transform(list_filter(string_split({text}, ' '), lambda w: w <> ''),
    lambda w: list_transform(range(1, length(w) + 1), lambda i: substring(' ' || w || ' ', i, 3))))"""


def similarity(p: str, rec: str, text: str, k: int, fit: int | None = None, terms=word_terms, keep: int = 6) -> None:
    """Register ``<p>_topk`` and what leads to it for one text of the records ``rec``."""
    cte(
        f"{p}_tf",
        (rec,),
        f"""SELECT src, cc, id, term, count(*) AS tf FROM
        (SELECT src, cc, entity_id AS id, unnest({terms(text)}) AS term FROM {rec}) GROUP BY ALL""",
    )
    sample = f"WHERE rn <= {fit}" if fit else ""
    cte(
        f"{p}_fit",
        (rec,),
        f"""SELECT cc, id FROM (SELECT cc, entity_id AS id,
        row_number() OVER (PARTITION BY cc ORDER BY md5(entity_id), entity_id) AS rn FROM {rec} WHERE src > 1) {sample}""",
    )
    cte(f"{p}_n", (f"{p}_fit",), f"SELECT cc, count(*) AS n FROM {p}_fit GROUP BY cc")
    cte(
        f"{p}_vocab",
        (f"{p}_tf", f"{p}_fit", f"{p}_n"),
        f"""SELECT cc, term, df, total, n, ln((1 + n) / (1 + df)) + 1 AS idf FROM (
        SELECT *, row_number() OVER (PARTITION BY cc ORDER BY total DESC, md5(term), term) AS rn FROM (
        SELECT cc, term, count(*) AS df, sum(tf)::BIGINT AS total, n FROM {p}_tf JOIN {p}_fit USING (cc, id) JOIN {p}_n USING (cc)
        GROUP BY cc, term, n) WHERE df >= 2 AND df <= 0.1::DOUBLE * n AND 0.1::DOUBLE * n >= 2) WHERE rn <= 40000""",
    )
    cte(
        f"{p}_w",
        (f"{p}_tf", f"{p}_vocab"),
        f"""SELECT src, cc, id, term, df, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY src, cc, id)) AS w
        FROM {p}_tf JOIN {p}_vocab USING (cc, term)""",
    )
    cte(
        f"{p}_q",
        (f"{p}_w",),
        f"""SELECT * FROM (SELECT cc, id AS s1_id, term, w, row_number() OVER (PARTITION BY id ORDER BY df, term) AS rn
        FROM {p}_w WHERE src = 1) WHERE rn <= {keep}""",
    )
    cte(
        f"{p}_scores",
        (f"{p}_q", f"{p}_w"),
        f"""SELECT q.cc, q.s1_id, c.id AS c_id, sum(q.w * c.w) AS score FROM {p}_q q JOIN {p}_w c
        ON q.cc = c.cc AND q.term = c.term AND c.src > 1 GROUP BY ALL""",
    )
    cte(
        f"{p}_topk",
        (f"{p}_scores",),
        f"""SELECT s1_id, c_id, score, rank FROM (SELECT *, row_number() OVER
        (PARTITION BY s1_id ORDER BY round(score, 9) DESC, c_id) AS rank FROM {p}_scores) WHERE rank <= {k}""",
    )


def merged(p: str, rec: str, cap: int, name: str, addr: str | None) -> None:
    """Register ``<p>_exact`` and ``<p>_pairs`` (the merged lists)."""
    cte(
        f"{p}_exact",
        (rec,),
        f"""SELECT s1_id, c_id, pos, namesakes FROM (SELECT a.entity_id AS s1_id, b.entity_id AS c_id,
        row_number() OVER (PARTITION BY a.entity_id ORDER BY b.src, b.entity_id) AS pos,
        count(*) OVER (PARTITION BY a.entity_id) AS namesakes
        FROM {rec} a JOIN {rec} b ON a.cc = b.cc AND a.nn = b.nn AND a.nn <> '' AND a.src = 1 AND b.src > 1) WHERE pos <= {cap}""",
    )
    second = f"UNION ALL SELECT s1_id, c_id, 2, rank, score FROM {addr}" if addr else ""
    cte(
        f"{p}_pairs",
        tuple(x for x in (f"{p}_exact", name, addr) if x),
        f"""SELECT s1_id, c_id, pos, via_exact, name_score, addr_score,
        coalesce(name_score, 0.9::DOUBLE * addr_score, 1.0::DOUBLE) AS cosine FROM (
        SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY spot) AS pos FROM (
        SELECT s1_id, c_id, min(stream * 1000 + rank) AS spot, max(CASE WHEN stream = 0 THEN 1 ELSE 0 END) AS via_exact,
        max(CASE WHEN stream = 1 THEN score END) AS name_score, max(CASE WHEN stream = 2 THEN score END) AS addr_score
        FROM (SELECT s1_id, c_id, 0 AS stream, pos AS rank, 1.0::DOUBLE AS score FROM {p}_exact
        UNION ALL SELECT s1_id, c_id, 1, rank, score FROM {name} {second}) GROUP BY s1_id, c_id)) WHERE pos <= {cap}""",
    )


for _f in ("p", "d"):
    similarity(f"{_f}n", f"{_f}_rec", "nn", 18)
    similarity(f"{_f}a", f"{_f}_rec", "na", 14)
    merged(_f, f"{_f}_rec", 42, f"{_f}n_topk", f"{_f}a_topk")
BLOCKING_TEXT = "CASE WHEN nn <> '' AND na <> '' THEN nn || ' ' || nn || ' ' || na WHEN nn <> '' THEN nn ELSE na END"
similarity("pt", "p_rec", BLOCKING_TEXT, 20)
merged("pt", "p_rec", 30, "pt_topk", None)
similarity("pf", "p_rec", "nn", 18, fit=300)
similarity("pc", "p_rec", "nn", 18, terms=char_terms)

# ---------------------------------------------------------------- pairs with both sides

cte(
    "p_sided",
    ("p_pairs", "p_rec"),
    """SELECT s1_id, c_id, pos, cosine, a.nn AS nn1, a.na AS na1, a.cc AS cc1, b.nn AS nn2, b.na AS na2, b.cc AS cc2
    FROM p_pairs JOIN p_rec a ON a.entity_id = s1_id JOIN p_rec b ON b.entity_id = c_id""",
)


def jaccard(a: str, b: str) -> str:
    inter = f"len(list_intersect(list_distinct({toks(a)}), list_distinct({toks(b)})))"
    union = f"len(list_distinct(list_concat({toks(a)}, {toks(b)})))"
    return f"CASE WHEN {union} = 0 THEN 1.0::DOUBLE ELSE {inter} / {union} END"


def lcs(a: str, b: str) -> str:
    """Bit-vector LCS in 64-bit integers, for texts of up to 62 characters."""
    mask = f"list_sum(list_transform(range(length({a})), lambda i: CASE WHEN substring({a}, (i + 1)::INT, 1) = c THEN 1::BIGINT << i ELSE 0::BIGINT END))::BIGINT"
    full = f"((1::BIGINT << length({a})) - 1)"
    masks = f"list_transform(string_split({b}, ''), lambda c: {mask})"
    step = f"((v + (v & m)) | (v - (v & m))) & {full}"
    return (
        f"CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE length({a}) - "
        f"bit_count(list_reduce(list_concat([{full}], {masks}), lambda v, m: {step})) END"
    )


def partial(x: str, y: str) -> str:
    """Best window ratio of ``x`` over ``y`` (not shorter); ``m`` holds the letter masks of ``y``."""
    full = f"((1::BIGINT << length({x})) - 1)"
    step = f"((v + (v & k)) | (v - (v & k))) & {full}"

    def of(window: str, size: str) -> str:
        common = f"(length({x}) - bit_count(list_reduce(list_concat([{full}], {window}), lambda v, k: {step})))"
        return f"2.0::DOUBLE * {common} / (length({x}) + {size})"

    size = f"least(length({x}), length({y}) - s)"
    inner = f"list_transform(range(length({y})), lambda s: {of(f'm[(s + 1):(s + {size})]', size)})"
    prefix = f"list_transform(range(1, length({x})), lambda j: {of('m[1:j]', 'j')})"
    return f"list_max(list_concat({inner}, {prefix}))"


def letter_masks(x: str, y: str) -> str:
    mask = f"list_sum(list_transform(range(length({x})), lambda i: CASE WHEN substring({x}, (i + 1)::INT, 1) = c THEN 1::BIGINT << i ELSE 0::BIGINT END))::BIGINT"
    return f"list_transform(string_split({y}, ''), lambda c: {mask})"


def ratio(a: str, b: str, lcs_column: str) -> str:
    return f"CASE WHEN length({a}) + length({b}) = 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * {lcs_column} / (length({a}) + length({b})) END"


def sorted_text(x: str) -> str:
    return f"array_to_string(list_sort({toks(x)}), ' ')"


def token_set_parts(a: str, b: str) -> str:
    """``i, x, y`` of the set ratio as three columns."""
    ta, tb = f"list_distinct({toks(a)})", f"list_distinct({toks(b)})"
    return (
        f"array_to_string(list_sort(list_intersect({ta}, {tb})), ' ') AS i, "
        f"array_to_string(list_sort(list_filter({ta}, lambda t: NOT list_contains({tb}, t))), ' ') AS x, "
        f"array_to_string(list_sort(list_filter({tb}, lambda t: NOT list_contains({ta}, t))), ' ') AS y"
    )


def token_set(a: str, b: str) -> str:
    g = "(CASE WHEN length(i) > 0 THEN 1 ELSE 0 END)"
    whole = f"(1.0::DOUBLE - (length(x) + length(y) - 2 * l) / (2 * (length(i) + {g}) + length(x) + length(y)))"
    left = f"(1.0::DOUBLE - ({g} + length(x)) / (2 * length(i) + {g} + length(x)))"
    right = f"(1.0::DOUBLE - ({g} + length(y)) / (2 * length(i) + {g} + length(y)))"
    return (
        f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE WHEN i <> '' AND (x = '' OR y = '') THEN 1.0::DOUBLE "
        f"WHEN i = '' THEN {whole} ELSE greatest({whole}, {left}, {right}) END"
    )


cte("name_pairs", ("p_sided",), "SELECT DISTINCT nn1, nn2 FROM p_sided")
cte(
    "name_partials",
    ("name_pairs",),
    f"""SELECT nn1, nn2, max({partial('x', 'y')}) AS partial FROM (
    SELECT *, {letter_masks('x', 'y')} AS m FROM (
    SELECT nn1, nn2, CASE WHEN length(nn1) <= length(nn2) THEN nn1 ELSE nn2 END AS x,
    CASE WHEN length(nn1) <= length(nn2) THEN nn2 ELSE nn1 END AS y FROM name_pairs
    UNION ALL SELECT nn1, nn2, nn2, nn1 FROM name_pairs WHERE length(nn1) = length(nn2)))
    GROUP BY nn1, nn2""",
)


def equal(a: str, b: str) -> str:
    return f"(CASE WHEN {a} = {b} AND {a} <> '' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"


def _shared(a: str, b: str) -> str:
    return f"len(list_intersect(list_distinct({toks(a)}), list_distinct({toks(b)})))::DOUBLE"


# one relation per string ratio, keyed by the two texts it compares
cte(
    "text_pairs",
    ("p_sided",),
    "SELECT DISTINCT a, b FROM (SELECT nn1 AS a, nn2 AS b FROM p_sided UNION ALL SELECT na1, na2 FROM p_sided)",
)
cte("text_ratio", ("text_pairs",), f"SELECT a, b, {ratio('a', 'b', 'l')} AS r FROM (SELECT *, {lcs('a', 'b')} AS l FROM text_pairs)")
cte(
    "text_sort",
    ("text_pairs",),
    f"""SELECT a, b, {ratio('sa', 'sb', 'l')} AS r FROM (SELECT *, {lcs('sa', 'sb')} AS l FROM
    (SELECT a, b, {sorted_text('a')} AS sa, {sorted_text('b')} AS sb FROM text_pairs))""",
)
cte(
    "text_set",
    ("text_pairs",),
    f"""SELECT a, b, {token_set('a', 'b')} AS r FROM (SELECT *, {lcs('x', 'y')} AS l FROM
    (SELECT a, b, {token_set_parts('a', 'b')} FROM text_pairs))""",
)
cte(
    "p_features",
    ("p_sided", "text_ratio", "text_sort", "text_set", "name_partials"),
    f"""SELECT s1_id, c_id, {equal('p.nn1', 'p.nn2')} AS name_exact, {jaccard('p.nn1', 'p.nn2')} AS name_jaccard,
    nr.r AS name_ratio, ns.r AS name_token_sort, nt.r AS name_token_set, np.partial AS name_partial,
    {equal('na1', 'na2')} AS addr_exact, {jaccard('na1', 'na2')} AS addr_jaccard, ar.r AS addr_ratio, aset.r AS addr_token_set,
    CASE WHEN cc1 = cc2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS country_exact,
    abs(length(p.nn1) - length(p.nn2))::DOUBLE AS name_len_diff, abs(length(na1) - length(na2))::DOUBLE AS addr_len_diff,
    {_shared('p.nn1', 'p.nn2')} AS common_name_tokens, {_shared('na1', 'na2')} AS common_addr_tokens, cosine AS tfidf_cosine
    FROM p_sided p JOIN text_ratio nr ON nr.a = p.nn1 AND nr.b = p.nn2 JOIN text_ratio ar ON ar.a = na1 AND ar.b = na2
    JOIN text_sort ns ON ns.a = p.nn1 AND ns.b = p.nn2 JOIN text_set nt ON nt.a = p.nn1 AND nt.b = p.nn2
    JOIN text_set aset ON aset.a = na1 AND aset.b = na2 JOIN name_partials np ON np.nn1 = p.nn1 AND np.nn2 = p.nn2""",
)

# ---------------------------------------------------------------- scores, truth, evaluation

cte(
    "p_scored",
    ("p_sided",),
    f"SELECT s1_id, c_id, pos, round((({jaccard('nn1', 'nn2')}) + cosine) / 2, 6) AS prob FROM p_sided",
)


def f05(hits: str, predicted: str, actual: str) -> str:
    pr, re = f"({hits} / {predicted})", f"({hits} / {actual})"
    return (
        f"CASE WHEN {actual} = 0 AND {predicted} = 0 THEN 1.0::DOUBLE WHEN {actual} = 0 OR {predicted} = 0 OR {hits} = 0 "
        f"THEN 0.0::DOUBLE ELSE 1.25::DOUBLE * {pr} * {re} / (0.25::DOUBLE * {pr} + {re}) END"
    )


cte("p_links", ("p_scored",), "SELECT s1_id, c_id, pos FROM p_scored WHERE prob >= 0.65")
cte(
    "p_f05",
    ("p_links", "p_truth"),
    f"""SELECT s1_id, {f05('hits', 'predicted', 'actual')} AS f05 FROM (
    SELECT t.s1_id, len(t.truth) AS actual, count(l.c_id) AS predicted,
    count(CASE WHEN list_contains(t.truth, l.c_id) THEN 1 END) AS hits
    FROM p_truth t LEFT JOIN p_links l USING (s1_id) GROUP BY t.s1_id, t.truth)""",
)
cte(
    "p_held",
    ("p_rec",),
    """SELECT s1_id FROM (SELECT entity_id AS s1_id, row_number() OVER (ORDER BY md5(entity_id), entity_id) AS rn,
    count(*) OVER () AS n FROM p_rec WHERE src = 1) WHERE rn <= ceil(n * 0.2::DOUBLE)""",
)
cte(
    "p_sweep",
    ("p_scored", "p_truth"),
    f"""SELECT threshold, avg({f05('hits', 'predicted', 'actual')}) AS score FROM (
    SELECT threshold, t.s1_id, len(t.truth) AS actual, count(s.c_id) AS predicted,
    count(CASE WHEN list_contains(t.truth, s.c_id) THEN 1 END) AS hits
    FROM (SELECT unnest([0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]::DOUBLE[]) AS threshold) g
    CROSS JOIN p_truth t LEFT JOIN p_scored s ON s.s1_id = t.s1_id AND s.prob >= threshold
    GROUP BY threshold, t.s1_id, t.truth) GROUP BY threshold""",
)
cte(
    "p_sample",
    ("p_raw",),
    """SELECT entity_id, country FROM (SELECT entity_id, country,
    row_number() OVER (PARTITION BY country ORDER BY md5(entity_id), entity_id) AS rn,
    CASE WHEN count(*) OVER () <= 120 THEN count(*) OVER (PARTITION BY country)
    ELSE round(120 * count(*) OVER (PARTITION BY country) / count(*) OVER ()) END AS quota
    FROM p_raw WHERE src = 1) WHERE rn <= quota""",
)
cte(
    "p_lists",
    ("p_rec", "p_links"),
    """SELECT r.entity_id AS source1_entity_id, coalesce(string_agg(l.c_id, ',' ORDER BY l.pos), '') AS matched_entity_ids
    FROM p_rec r LEFT JOIN p_links l ON l.s1_id = r.entity_id WHERE r.src = 1 GROUP BY r.entity_id""",
)
cte(
    "p_cand_lists",
    ("p_rec", "p_pairs"),
    """SELECT r.entity_id AS source1_entity_id, coalesce(string_agg(l.c_id, ',' ORDER BY l.pos), '') AS candidate_entity_ids
    FROM p_rec r LEFT JOIN p_pairs l ON l.s1_id = r.entity_id WHERE r.src = 1 GROUP BY r.entity_id""",
)

# ---------------------------------------------------------------- link lines with every fault

cte(
    "lines",
    (),
    """SELECT p_partkey AS k, line FROM (SELECT p_partkey, unnest(CASE p_size
    WHEN 1 THEN ['S1-' || p_partkey || chr(9) || 'S2-' || p_partkey || ',S2-' || p_partkey]
    WHEN 2 THEN ['S1-' || p_partkey || chr(9) || 'S1-' || p_partkey || ',S2-' || p_partkey]
    WHEN 3 THEN ['S1-' || p_partkey || chr(9) || 'X9-' || p_partkey]
    WHEN 4 THEN ['S1-' || p_partkey || chr(9) || 'S2-' || p_partkey || ',,S3-' || p_partkey]
    WHEN 5 THEN ['S1-' || p_partkey || chr(9) || 'S2-' || p_partkey || '0000000']
    WHEN 6 THEN []
    WHEN 7 THEN ['S1-' || p_partkey || chr(9), 'S1-' || p_partkey || chr(9) || 'S2-' || p_partkey]
    WHEN 8 THEN ['S1-' || p_partkey || chr(9), 'S1-' || p_partkey || '0000000' || chr(9)]
    WHEN 9 THEN ['S1-' || p_partkey || chr(9), 'S1-' || p_partkey || ' S2-' || p_partkey]
    WHEN 10 THEN ['S1-' || p_partkey || chr(9), '   ']
    ELSE ['S1-' || p_partkey || chr(9) || CASE WHEN p_type = 'PROMO' THEN '' ELSE 'S2-' || p_partkey END]
    END) AS line FROM part)""",
)
cte(
    "link_rows",
    ("lines",),
    """SELECT k, split_part(line, chr(9), 1) AS s1_id, CASE WHEN trim(split_part(line, chr(9), 2)) = '' THEN []
    ELSE string_split(split_part(line, chr(9), 2), ',') END AS ids FROM lines WHERE contains(line, chr(9))""",
)
cte("link_ids", ("link_rows",), "SELECT s1_id, unnest(ids) AS c_id FROM link_rows")
cte(
    "issues",
    ("link_rows", "link_ids", "lines", "p_rec", "p_pairs"),
    r"""SELECT DISTINCT * FROM (
    SELECT 'malformed' AS rule, line AS item FROM lines WHERE NOT contains(line, chr(9)) AND trim(line) <> ''
    UNION ALL SELECT 'duplicate_rows', s1_id FROM link_rows GROUP BY s1_id HAVING count(*) > 1
    UNION ALL SELECT 'duplicate_ids', s1_id FROM link_rows WHERE len(ids) <> len(list_distinct(ids))
    UNION ALL SELECT 'self_match', c_id FROM link_ids WHERE starts_with(c_id, 'S1-')
    UNION ALL SELECT 'prefix', c_id FROM link_ids WHERE NOT regexp_matches(c_id, '^S[123]-')
    UNION ALL SELECT 'unknown_ids', c_id FROM link_ids WHERE regexp_matches(c_id, '^S[23]-')
      AND c_id NOT IN (SELECT entity_id FROM p_rec WHERE src > 1)
    UNION ALL SELECT 'missing_s1', entity_id FROM p_rec WHERE src = 1 AND entity_id NOT IN (SELECT s1_id FROM link_rows)
    UNION ALL SELECT 'extra_s1', s1_id FROM link_rows WHERE s1_id NOT IN (SELECT entity_id FROM p_rec WHERE src = 1)
    UNION ALL SELECT 'subset', s1_id FROM link_ids l WHERE NOT EXISTS
      (SELECT 1 FROM p_pairs p WHERE p.s1_id = l.s1_id AND p.c_id = l.c_id))""",
)
