"""Reference SQL: named common table expressions and the WITH clauses built from them.

The texts are plain ANSI SQL as DuckDB runs it; they check the registered
queries and are not used to compute anything.
"""

from ratelake.functions.text import ENGLISH_STOP_WORDS


def rnd(x, digits: int) -> str:
    """Round half to even in binary floating point."""
    return f"(round_even(({x}) * 1e{digits}, 0) / 1e{digits} + 0.0::DOUBLE)"


def div0(a, b) -> str:
    return f"(cast({a} AS double) / nullif(cast({b} AS double), 0))"


TS_MIN, TS_MAX = 946684800, 1893456000
_STOP = ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS)

# name -> (names it needs, body)
CTES = {
    "R": ((), """SELECT cast(o_custkey AS varchar) AS "userId", cast(l_partkey AS varchar) AS "productId",
        cast((cast(l_quantity AS int) - 1) % 5 + 1 AS double) AS rating,
        datediff('day', DATE '1970-01-01', cast(l_shipdate AS date)) * 86400 AS "timestamp"
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "P": ((), """SELECT cast(p_partkey AS varchar) AS "productId", p_name AS title,
        CASE WHEN NOT (p_partkey % 3 = 0 OR p_type = 'SMALL') THEN p_retailprice END AS price,
        p_brand AS brand, CASE WHEN p_partkey % 11 <> 0 THEN p_type END AS category, text AS description
        FROM part LEFT JOIN documents ON doc_id = p_partkey"""),
    "HIGHEST": (("R",), """SELECT "userId", "productId", rating, "timestamp" FROM (SELECT DISTINCT * FROM R)
        QUALIFY row_number() OVER (PARTITION BY "userId", "productId"
                                   ORDER BY rating DESC, "timestamp" DESC) = 1"""),
    "CR": (("HIGHEST",), f"""SELECT * FROM HIGHEST WHERE "timestamp" BETWEEN {TS_MIN} AND {TS_MAX}"""),
    "CATMED": (("P",), "SELECT category AS c, median(price) AS m FROM P WHERE category IS NOT NULL GROUP BY 1"),
    "HALFFILLED": (("P", "CATMED"), """SELECT "productId", title, coalesce(price, m) AS price, brand, category,
        description FROM P LEFT JOIN CATMED ON category = c"""),
    "IMPUTED": (("HALFFILLED",), """SELECT "productId", title,
        coalesce(price, (SELECT median(price) FROM HALFFILLED)) AS price, brand, category, description
        FROM HALFFILLED"""),
    "CP": (("IMPUTED",), """SELECT "productId", coalesce(title, 'Untitled') AS title, price,
        coalesce(brand, 'Unknown') AS brand, coalesce(category, 'Unknown') AS category,
        coalesce(description, '') AS description FROM IMPUTED"""),
    "CHECKSUM": (("CR",), """SELECT count(*) AS "rows", coalesce(sum(('0x' || substr(md5('{"userId":"' || "userId" || '","productId":"'
        || "productId" || '","rating":' || rating || ',"timestamp":' || "timestamp" || '}'), 1, 15))::BIGINT), 0)::VARCHAR
        AS checksum FROM CR"""),
    "STATS": (("R",), f"""SELECT "productId", count(rating) AS rating_count, {rnd('avg(rating)', 2)} AS avg_rating
        FROM R GROUP BY 1"""),
    "EP": (("CP", "STATS"), f"""SELECT CP.*, coalesce(rating_count, 0) AS rating_count,
        {rnd('coalesce(avg_rating, 0.0)', 2)} AS avg_rating
        FROM CP LEFT JOIN STATS ON CP."productId" = STATS."productId" """),
    "DIVERSITY": (("CR", "CP"), """SELECT "userId", count(DISTINCT category) AS user_category_diversity
        FROM CR LEFT JOIN CP ON CR."productId" = CP."productId" GROUP BY 1"""),
    "UF": (("CR", "DIVERSITY"), f"""SELECT "userId", user_rating_count, user_avg_rating, user_rating_std,
        user_unique_items, user_recency_days, user_category_diversity FROM (
          SELECT "userId" AS u, count(rating) AS user_rating_count, {rnd('avg(rating)', 4)} AS user_avg_rating,
          {rnd('coalesce(stddev_samp(rating), 0.0)', 4)} AS user_rating_std,
          count(DISTINCT "productId") AS user_unique_items,
          {rnd('((SELECT max("timestamp") FROM CR) - max("timestamp")) / 86400.0::DOUBLE', 1)}
            AS user_recency_days FROM CR GROUP BY 1) JOIN DIVERSITY ON u = "userId" """),
    "IB": (("CR", "CP"), """SELECT s.*, price, coalesce(category, 'Unknown') AS category,
        coalesce(brand, 'Unknown') AS brand FROM (
          SELECT "productId", count(rating) AS item_rating_count, avg(rating) AS item_avg_rating,
          coalesce(stddev_samp(rating), 0.0) AS item_rating_std, count(DISTINCT "userId") AS item_unique_users
          FROM CR GROUP BY 1) s LEFT JOIN CP ON s."productId" = CP."productId" """),
    "CATCODE": (("IB",), """SELECT v, cast(row_number() OVER (ORDER BY v) - 1 AS int) AS code
        FROM (SELECT DISTINCT category AS v FROM IB)"""),
    "BRANDCODE": (("IB",), """SELECT v, cast(row_number() OVER (ORDER BY v) - 1 AS int) AS code
        FROM (SELECT DISTINCT brand AS v FROM IB)"""),
    "IF": (("IB", "CATCODE", "BRANDCODE"), f"""SELECT "productId", item_rating_count,
        {rnd('item_avg_rating', 4)} AS item_avg_rating, {rnd('item_rating_std', 4)} AS item_rating_std,
        item_unique_users, {rnd('x', 4)} AS price, category, brand, a.code AS category_encoded,
        b.code AS brand_encoded, CASE WHEN hi = lo THEN 0.0::DOUBLE ELSE {rnd('(x - lo) / nullif(hi - lo, 0)', 4)}
        END AS price_normalized
        FROM (SELECT *, coalesce(price, (SELECT median(price) FROM IB)) AS x FROM IB)
        JOIN CATCODE a ON a.v = category JOIN BRANDCODE b ON b.v = brand,
        (SELECT min(price) AS lo, max(price) AS hi FROM IB)"""),
    "INTER": (("CR", "IF"), f"""SELECT "userId", CR."productId", rating, "timestamp",
        {rnd('(rating - 1) / 4', 4)} AS rating_normalized, "timestamp" // 86400 AS days_since_epoch,
        {rnd('rating - item_avg_rating', 4)} AS user_item_rating_diff
        FROM CR LEFT JOIN "IF" ON CR."productId" = "IF"."productId" """),
    "TOPITEMS": (("CR",), """SELECT "productId" FROM CR GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 500"""),
    "COOC": (("CR", "TOPITEMS"), """SELECT "productId", "co_productId", cooc_score FROM (
          SELECT a."productId", b."productId" AS "co_productId", cast(count(*) AS double) AS cooc_score
          FROM CR a JOIN CR b ON a."userId" = b."userId" AND a."productId" <> b."productId"
          WHERE a."productId" IN (SELECT "productId" FROM TOPITEMS)
            AND b."productId" IN (SELECT "productId" FROM TOPITEMS) GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY "productId" ORDER BY cooc_score DESC, "co_productId") <= 3"""),
    "MU": (("CR",), "SELECT avg(rating) AS mu FROM CR"),
    "ITEMOFF": (("CR", "MU"), f"""SELECT "productId", {rnd('avg(rating) - (SELECT mu FROM MU)', 9)} AS item_offset
        FROM CR GROUP BY 1"""),
    "USEROFF": (("CR", "MU", "ITEMOFF"), f"""SELECT "userId",
        {rnd('avg(rating - item_offset) - (SELECT mu FROM MU)', 9)} AS user_offset
        FROM CR JOIN ITEMOFF ON CR."productId" = ITEMOFF."productId" GROUP BY 1"""),
    "PRED": (("CR", "MU", "ITEMOFF", "USEROFF"), f"""SELECT CR."userId", CR."productId", rating,
        {rnd('least(greatest((SELECT mu FROM MU) + user_offset + item_offset, 1.0), 5.0)', 6)} AS prediction
        FROM CR JOIN ITEMOFF ON CR."productId" = ITEMOFF."productId"
        JOIN USEROFF ON CR."userId" = USEROFF."userId" """),
    "RECS": (("CR", "CP", "MU", "ITEMOFF", "USEROFF", "TOPITEMS"), f"""
        SELECT s."userId", rank, s."productId", predicted_rating, left(coalesce(title, 'Unknown'), 50) AS title,
        left(coalesce(category, 'Unknown'), 40) AS category, price, brand FROM (
          SELECT *, cast(row_number() OVER (PARTITION BY "userId"
            ORDER BY predicted_rating DESC, "productId") AS int) AS rank
          FROM (SELECT "userId", t."productId",
            {rnd('least(greatest((SELECT mu FROM MU) + user_offset + item_offset, 1.0), 5.0)', 3)}
              AS predicted_rating
            FROM USEROFF CROSS JOIN TOPITEMS t JOIN ITEMOFF ON t."productId" = ITEMOFF."productId"
            ANTI JOIN CR ON CR."userId" = USEROFF."userId" AND CR."productId" = t."productId")) s
        LEFT JOIN CP ON s."productId" = CP."productId" WHERE rank <= 10"""),
    "RATED": (("CP", "CR"), """SELECT * FROM CP WHERE "productId" IN (SELECT "productId" FROM CR)"""),
    "PROFILE": (("RATED",), """SELECT "productId", coalesce(title, '') || ' ' || coalesce(category, '') || ' ' ||
        coalesce(brand, '') || ' ' || left(coalesce(description, ''), 100) AS profile FROM RATED"""),
    "WORDS": (("PROFILE",), f"""SELECT "productId", unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (
        SELECT "productId", [x FOR x IN regexp_extract_all(lower(profile), '[\\p{{L}}\\p{{N}}_]{{2,}}') IF x NOT IN ({_STOP})] AS ws
        FROM PROFILE)"""),
    "TF": (("WORDS",), """SELECT "productId", term, count(*) AS tf FROM (
        SELECT "productId", w AS term FROM WORDS UNION ALL
        SELECT a."productId", a.w || ' ' || b.w FROM WORDS a JOIN WORDS b
        ON a."productId" = b."productId" AND b.i = a.i + 1) GROUP BY 1, 2"""),
    "VOCAB": (("TF", "PROFILE"), """SELECT term, cast(row_number() OVER (ORDER BY term) - 1 AS int) AS position, df,
        ln(((SELECT count(*) FROM PROFILE) + 1.0::DOUBLE) / (df + 1.0::DOUBLE)) + 1.0 AS idf FROM (
        SELECT term, count(*) AS df, sum(tf) AS total FROM TF GROUP BY 1 HAVING count(*) >= 2
        ORDER BY total DESC, term LIMIT 5000)"""),
    "WEIGHTS": (("TF", "VOCAB"), """SELECT "productId", term, position,
        tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY "productId")) AS weight
        FROM TF JOIN VOCAB USING (term)"""),
    "NEIGHBOURS": (("WEIGHTS",), f"""SELECT * EXCLUDE (raw), cast(row_number() OVER (PARTITION BY "productId"
          ORDER BY similarity DESC, "other_productId") AS int) AS rank FROM (
        SELECT a."productId", b."productId" AS "other_productId", {rnd('sum(a.weight * b.weight)', 6)} AS similarity,
               sum(a.weight * b.weight) AS raw
        FROM WEIGHTS a JOIN WEIGHTS b ON a.position = b.position AND a."productId" <> b."productId"
        GROUP BY 1, 2) WHERE raw > 0.01 QUALIFY rank <= 50"""),
}


def with_ctes(body: str, *names: str) -> str:
    """``body`` behind a WITH clause that holds ``names`` and everything they need."""
    order: list = []

    def visit(name):
        if name not in order:
            for need in CTES[name][0]:
                visit(need)
            order.append(name)

    for name in names:
        visit(name)
    if not order:
        return body
    parts = ",\n".join(f'"{n}" AS ({CTES[n][1]})' for n in order)
    return f"WITH {parts}\n{body}"
