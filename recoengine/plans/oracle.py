"""DuckDB SQL equivalents of the registered queries (the correctness
oracle). The fixture views are spelled out as CTEs over the driver's
tables so each statement is self-contained."""

from __future__ import annotations

from recoengine.fixtures import FIXTURE_GENRE_LABELS, ITEM_DIMS, SIMILAR_ABOVE, USER_DIMS
from recoengine.operators.statistics import GENRES

_G = "[" + ", ".join(f"'{g}'" for g in FIXTURE_GENRE_LABELS) + "]"

RATINGS = """ratings AS (
  SELECT o_custkey::INTEGER AS uid, l_partkey::INTEGER AS mid,
         ((l_quantity::INTEGER + l_linenumber) % 10 + 1) / 2.0::DOUBLE AS score,
         epoch(date_trunc('second', l_shipdate))::BIGINT AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

MOVIES = f"""movies AS (
  SELECT p_partkey::INTEGER AS mid, p_name AS name, '' AS descri, p_size || ' minutes' AS timelong,
         '' AS issue, '1995' AS shoot, 'English' AS language,
         list_extract({_G}, (p_partkey % 22 + 1)::INTEGER) || '|' ||
         list_extract({_G}, (p_size % 22 + 1)::INTEGER) AS genres,
         p_brand AS actors, p_type AS directors
  FROM part)"""

TAGS = """tags AS (
  SELECT user_id::INTEGER AS uid, CAST(props->>'k' AS INTEGER) AS mid, event_type AS tag,
         floor(epoch(ts))::BIGINT AS "timestamp"
  FROM events)"""

REVENTS = """revents AS (
  SELECT event_id, user_id::INTEGER AS uid, CAST(props->>'k' AS INTEGER) AS mid,
         (CAST(floor(value) AS INTEGER) % 10 + 1) / 2.0::DOUBLE AS score, ts,
         floor(epoch(ts))::BIGINT AS "timestamp", event_type
  FROM events)"""

RECENT = """recent AS (
  SELECT uid, pos, mid, score FROM (
    SELECT uid, mid, score,
           (row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) - 1)::INTEGER AS pos
    FROM revents WHERE event_type = 'click') WHERE pos <= 20)"""

_GENRE_VALUES = ", ".join(f"('{g}')" for g in GENRES)


def _f(lo: int, hi: int, name: str) -> str:
    return (f"{name} AS (SELECT vec_id::INTEGER AS id, "
            f"list_transform(embedding[{lo}:{hi}], lambda x: x::DOUBLE) AS v FROM embeddings)")


IFACT = _f(ITEM_DIMS[0], ITEM_DIMS[1], "ifact")
UFACT = _f(USER_DIMS[0], USER_DIMS[1], "ufact")

SFACT = _f(1, 64, "sfact")

# cosine above the threshold over whole embeddings, no self pairs, both directions
ITEM_SIM = f"""inorm AS (SELECT id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS nrm FROM sfact),
isim AS (
  SELECT a.id AS mid, b.id AS sim_mid, list_dot_product(a.v, b.v) / (a.nrm * b.nrm) AS r
  FROM inorm a JOIN inorm b ON a.id <> b.id
  WHERE a.nrm > 0 AND b.nrm > 0 AND list_dot_product(a.v, b.v) / (a.nrm * b.nrm) > {SIMILAR_ABOVE})"""


STREAM = (REVENTS, RECENT, SFACT, ITEM_SIM + f""",
inp AS (SELECT uid, mid, score, "timestamp" FROM revents WHERE event_type = 'purchase'),
latest AS (SELECT uid, mid FROM (
  SELECT uid, mid, row_number() OVER (PARTITION BY uid ORDER BY "timestamp" DESC, mid DESC) AS rn FROM inp)
  WHERE rn = 1),
rated AS (SELECT DISTINCT uid, mid FROM revents WHERE event_type = 'view'),
c0 AS (SELECT l.uid, s.sim_mid AS mid, s.r FROM latest l JOIN isim s ON s.mid = l.mid
       WHERE NOT EXISTS (SELECT 1 FROM rated x WHERE x.uid = l.uid AND x.mid = s.sim_mid)),
cands AS (SELECT * FROM (
  SELECT uid, row_number() OVER (PARTITION BY uid ORDER BY r DESC, mid ASC)::INTEGER AS rank, mid, r FROM c0)
  WHERE rank <= 20),
j AS (SELECT c.uid, c.mid, s.r AS sim, rc.score FROM cands c JOIN recent rc ON rc.uid = c.uid
      JOIN isim s ON s.mid = c.mid AND s.sim_mid = rc.mid WHERE s.r > {SIMILAR_ABOVE}),
scored AS (SELECT uid, mid, avg(sim * score)
                 + log2(greatest(count(*) FILTER (WHERE score > 3), 1))
                 - log2(greatest(count(*) FILTER (WHERE score <= 3), 1)) AS r
           FROM j GROUP BY uid, mid)""")


# Rows that the invariants query counts; there must be none of any.
INVARIANTS = ["user without ratings", "item outside the movies", "score not positive", "rank out of 1 to 10",
              "scores not falling", "rank missing", "rated item among the unseen", "similar to itself",
              "similar one way only", "cosine out of range"]


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["rate_more"] = _with(RATINGS) + 'SELECT mid, count(1) AS "count" FROM ratings GROUP BY mid'
    q["rate_more_recently"] = _with(RATINGS) + (
        "SELECT mid, count(1) AS \"count\", strftime(make_timestamp(\"timestamp\" * 1000000), '%Y%m') AS yearmonth "
        "FROM ratings GROUP BY mid, yearmonth")
    q["rate_more_order"] = _with(RATINGS) + (
        'SELECT mid, count(1) AS "count", row_number() OVER (ORDER BY count(1) DESC, mid) AS place FROM ratings GROUP BY mid')
    q["rate_more_recently_order"] = _with(RATINGS) + """,
m AS (SELECT mid, count(1) AS "count", strftime(make_timestamp("timestamp" * 1000000), '%Y%m') AS yearmonth FROM ratings GROUP BY mid, yearmonth)
SELECT *, row_number() OVER (ORDER BY yearmonth DESC, "count" DESC, mid) AS place FROM m"""
    q["change_date_sql_udf"] = _with(RATINGS) + (
        "SELECT mid, uid, score, strftime(make_timestamp(\"timestamp\" * 1000000), '%Y%m') AS yearmonth FROM ratings")
    q["average_scores"] = _with(RATINGS) + "SELECT mid, avg(score) AS avg FROM ratings GROUP BY mid"
    q["genre_top10"] = _with(RATINGS, MOVIES, f"g(genre) AS (VALUES {_GENRE_VALUES})") + """,
avgs AS (SELECT mid, avg(score) AS avg FROM ratings GROUP BY mid),
j AS (SELECT g.genre AS genres, m.mid, a.avg FROM movies m JOIN avgs a ON m.mid = a.mid
      JOIN g ON contains(lower(m.genres), lower(g.genre))),
r AS (SELECT genres, row_number() OVER (PARTITION BY genres ORDER BY avg DESC, mid ASC)::INTEGER AS rank,
             mid, avg FROM j)
SELECT genres, rank, mid, avg FROM r WHERE rank <= 10"""
    q["rate_more_sql"] = q["rate_more"]
    q["rate_more_recently_sql"] = q["rate_more_recently"]
    q["average_scores_sql"] = q["average_scores"]
    q["tags_by_movie"] = _with(TAGS) + (
        "SELECT mid, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags FROM tags GROUP BY mid")
    q["search_documents"] = _with(MOVIES, TAGS) + """,
t AS (SELECT mid, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags FROM tags GROUP BY mid)
SELECT m.mid, name, descri, timelong, issue, shoot, language, genres, actors, directors, t.tags
FROM movies m LEFT JOIN t ON m.mid = t.mid"""
    q["load_movies_roundtrip"] = _with(MOVIES) + "SELECT * FROM movies"
    q["load_ratings_roundtrip"] = _with(RATINGS) + "SELECT * FROM ratings"
    q["load_tags_roundtrip"] = _with(TAGS) + "SELECT * FROM tags"
    q["write_read_table"] = _with(RATINGS) + "SELECT * FROM ratings"
    q["item_similarity"] = _with(SFACT, ITEM_SIM) + "SELECT mid, sim_mid, round(r, 4) AS r FROM isim"
    q["item_similarity_exploded"] = q["item_similarity"]
    q["item_similarity_lists"] = _with(SFACT, ITEM_SIM) + (
        "SELECT mid, row_number() OVER (PARTITION BY mid ORDER BY r DESC, sim_mid ASC)::INTEGER AS rank, sim_mid, "
        "round(r, 4) AS r FROM isim")
    q["stored_user_lists"] = _factor_top10(False)
    q["stored_genre_lists"] = q["genre_top10"].replace(
        "SELECT genres, rank, mid, avg FROM r", "SELECT genres, rank, mid, round(avg, 4) AS r FROM r")
    predicted = _with(RATINGS, IFACT, UFACT) + """,
p AS (SELECT r.uid, r.mid, r.score, list_dot_product(u.v, i.v) AS prediction
      FROM ratings r JOIN ufact u ON u.id = r.uid JOIN ifact i ON i.id = r.mid)"""
    q["predict_pairs"] = predicted + "SELECT uid, mid, score, CASE WHEN round(prediction, 4) = 0 THEN 0 ELSE round(prediction, 4) END AS prediction FROM p"
    q["training_rmse"] = predicted + """
SELECT round(sqrt(avg((a.score - p.prediction) * (a.score - p.prediction))), 6) AS rmse, count(*) AS n
FROM p a JOIN p ON a.uid = p.uid AND a.mid = p.mid"""
    q["als_invariants"] = "SELECT unnest([" + ", ".join(f"'{n}'" for n in INVARIANTS) + "]) AS name, 0::BIGINT AS n"
    q["als_half_step"] = _with(RATINGS, IFACT) + (
        "SELECT uid, count(*) AS n, 0.0::DOUBLE AS residual FROM ratings JOIN ifact ON mid = id GROUP BY uid")
    q["als_residuals"] = _with(RATINGS) + "SELECT uid, count(*) AS n, 0.0::DOUBLE AS residual FROM ratings GROUP BY uid"
    q["als_split_residuals"] = q["als_residuals"]
    # a rating matched k times counts k times
    q["grid_invariants"] = _with(RATINGS) + """,
pairs AS (SELECT count(*) AS k FROM ratings GROUP BY uid, mid)
SELECT 40 AS rank, 0.1::DOUBLE AS reg, 0 AS gap, sum(k * k)::BIGINT AS n, 0.0::DOUBLE AS residual FROM pairs"""
    q["factor_top10"] = _factor_top10(False)
    q["factor_top10_unseen"] = _factor_top10(True)
    q["item_similarity_chunks"], q["item_similarity_chunks_exploded"] = q["item_similarity_lists"], q["item_similarity"]
    q["ratings_of_top_movie"] = _with(RATINGS) + (
        "SELECT * FROM ratings WHERE mid = (SELECT mid FROM ratings GROUP BY mid ORDER BY count(*) DESC, mid LIMIT 1)")
    q["tags_of_user_and_movie"] = _with(TAGS) + (
        "SELECT * FROM tags WHERE uid = (SELECT uid FROM tags GROUP BY uid ORDER BY count(*) DESC, uid LIMIT 1) UNION ALL "
        "SELECT * FROM tags WHERE mid = (SELECT mid FROM tags GROUP BY mid ORDER BY count(*) DESC, mid LIMIT 1)")
    q["holdout_rmse"] = _with(RATINGS, IFACT, UFACT) + """,
placed AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY "timestamp" DESC, mid DESC, score DESC) AS place,
                  count(*) OVER (PARTITION BY uid) AS n FROM ratings),
scored AS (SELECT score - list_dot_product(u.v, i.v) AS e FROM placed JOIN ufact u ON u.id = uid JOIN ifact i ON i.id = mid WHERE place = 1 AND n > 1)
SELECT count(*) FILTER (WHERE place > 1 OR n = 1) AS train, count(*) FILTER (WHERE place = 1 AND n > 1) AS test,
       (SELECT count(*) FROM scored) AS scored, (SELECT round(sqrt(avg(e * e)), 6) FROM scored) AS rmse FROM placed"""
    q["item_similarity_pruned"] = q["item_similarity"]
    q["factor_top10_pruned"], q["factor_top10_unseen_pruned"] = q["factor_top10"], q["factor_top10_unseen"]
    q["rmse_join"] = _with(RATINGS) + """,
avgs AS (SELECT mid, avg(score) AS prediction FROM ratings GROUP BY mid),
pred AS (SELECT r.uid, r.mid, a.prediction FROM ratings r JOIN avgs a ON r.mid = a.mid)
SELECT round(sqrt(avg((a.score - p.prediction) * (a.score - p.prediction))), 6) AS rmse, count(*) AS n
FROM ratings a JOIN pred p ON a.uid = p.uid AND a.mid = p.mid"""
    q["decode_ratings"] = _with(REVENTS) + 'SELECT uid, mid, score, "timestamp" FROM revents'
    q["recent_ratings"] = _with(REVENTS, RECENT) + "SELECT uid, pos, mid, score FROM recent"
    q["parse_recent_list"] = q["recent_ratings"]
    q["stream_recent_ratings"] = _with(REVENTS) + """
SELECT uid, pos, mid, score FROM (
  SELECT uid, mid, score, (row_number() OVER (PARTITION BY uid ORDER BY "timestamp" DESC, mid DESC, score DESC) - 1)::INTEGER AS pos
  FROM revents WHERE event_type = 'click') WHERE pos <= 20"""
    q["stream_candidates"] = _with(*STREAM) + "SELECT uid, rank, mid, round(r, 4) AS r FROM cands"
    q["stream_scores"] = _with(*STREAM) + "SELECT uid, mid, round(r, 4) AS r FROM scored"
    q["stream_recommend"] = _with(*STREAM) + """,
users AS (SELECT DISTINCT uid FROM inp)
SELECT u.uid, coalesce(string_agg(printf('%d:%.4f', s.mid, round(s.r, 4)), '|' ORDER BY s.r DESC, s.mid ASC), '')
       AS recs_str
FROM users u LEFT JOIN scored s ON s.uid = u.uid GROUP BY u.uid"""
    return q


def _factor_top10(exclude_seen: bool) -> str:
    anti = ("WHERE NOT EXISTS (SELECT 1 FROM ratings s WHERE s.uid = u.id AND s.mid = i.id)"
            if exclude_seen else "")
    return _with(RATINGS, MOVIES, IFACT, UFACT) + f""",
u AS (SELECT * FROM ufact WHERE id IN (SELECT uid FROM ratings)),
i AS (SELECT * FROM ifact WHERE id IN (SELECT mid FROM movies)),
p AS (SELECT u.id AS uid, i.id AS mid, list_dot_product(u.v, i.v) AS r FROM u CROSS JOIN i {anti}),
k AS (SELECT uid, row_number() OVER (PARTITION BY uid ORDER BY r DESC, mid ASC)::INTEGER AS rank, mid, r
      FROM p WHERE r > 0)
SELECT uid, rank, mid, round(r, 4) AS r FROM k WHERE rank <= 10"""
