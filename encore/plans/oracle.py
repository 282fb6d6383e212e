"""DuckDB-runnable SQL for every registered query (the correctness oracle).

Fixture lists are CTEs over the driver views, mirroring
``sources/fixtures.py``; each metric is then written independently in plain
SQL with the same column names and types as the Spark result.
"""

from __future__ import annotations

FIXTURE_SQL = {
    "plays": """
SELECT o_custkey AS user_id, s_name AS artist_name,
       concat('Part#', CAST(p_partkey AS VARCHAR)) AS track_name,
       concat(p_brand, ' ', p_type) AS album_name,
       r_name AS region, p_type, l_returnflag, l_quantity AS qty, l_orderkey, l_linenumber
FROM lineitem
JOIN orders   ON l_orderkey = o_orderkey
JOIN part     ON l_partkey  = p_partkey
JOIN supplier ON l_suppkey  = s_suppkey
JOIN nation   ON s_nationkey = n_nationkey
JOIN region   ON n_regionkey = r_regionkey""",
    "user_top_artists": """
SELECT user_id, artist_name, playcount,
       CAST(row_number() OVER (PARTITION BY user_id
            ORDER BY playcount DESC, artist_name ASC NULLS FIRST) AS INTEGER) AS rank
FROM (SELECT user_id, artist_name, CAST(sum(qty) AS BIGINT) AS playcount
      FROM plays GROUP BY user_id, artist_name) a""",
    "user_top_tracks": """
SELECT user_id, track_name, artist_name, CAST(sum(qty) AS BIGINT) AS playcount
FROM plays GROUP BY user_id, track_name, artist_name""",
    "user_top_albums": """
SELECT user_id, album_name, CAST(sum(qty) AS BIGINT) AS playcount
FROM plays GROUP BY user_id, album_name""",
    "user_top_types": """
SELECT user_id, p_type AS track_name, CAST(sum(qty) AS BIGINT) AS playcount
FROM plays GROUP BY user_id, p_type""",
    "user_tracks_by_region": """
SELECT user_id, track_name, region AS artist_name, CAST(sum(qty) AS BIGINT) AS playcount
FROM plays GROUP BY user_id, track_name, region""",
    "plays_by_region": """
SELECT user_id, region AS artist_name, track_name, CAST(qty AS BIGINT) AS playcount,
       l_orderkey, l_linenumber
FROM plays""",
    "user_artists_dirty": """
SELECT user_id,
       CASE WHEN l_orderkey % 97 = 0 THEN NULL
            WHEN l_orderkey % 89 = 0 THEN ''
            ELSE artist_name END AS artist_name,
       CAST(qty AS BIGINT) AS playcount
FROM plays""",
    "user_fine_items": """
SELECT DISTINCT user_id, concat(artist_name, '/', album_name) AS artist_name
FROM plays""",
}


def with_fixtures(body: str, *names: str, ctes: tuple[tuple[str, str], ...] = ()) -> str:
    """Prefix ``body`` with the named fixture CTEs (plays first), then ``ctes``."""
    ordered = ["plays"] + [n for n in names if n != "plays"]
    parts = [(n, FIXTURE_SQL[n]) for n in ordered] + list(ctes)
    return "WITH " + ",\n".join(f"{n} AS ({q}\n)" for n, q in parts) + "\n" + body


def _top_items(table: str, item: str, k: int = 20) -> str:
    return with_fixtures(f"""
SELECT {item}, CAST(count(DISTINCT user_id) AS BIGINT) AS users_count,
       100.0E0 * count(DISTINCT user_id)
         / greatest((SELECT count(*) FROM (SELECT DISTINCT user_id FROM {table}) u), 1) AS percentage
FROM {table}
GROUP BY {item}
ORDER BY users_count DESC, {item} ASC NULLS FIRST
LIMIT {k}""", table)


def _first_artist(table: str = "user_top_artists") -> str:
    return f"""
SELECT user_id, artist_name FROM (
  SELECT user_id, artist_name,
         row_number() OVER (PARTITION BY user_id
                            ORDER BY playcount DESC NULLS LAST, artist_name ASC NULLS FIRST) AS rn
  FROM {table}) r
WHERE rn = 1"""


ORACLE: dict[str, str] = {}

ORACLE["top_artists"] = _top_items("user_top_artists", "artist_name")
ORACLE["top_tracks"] = _top_items("user_top_tracks", "track_name")
ORACLE["top_albums"] = _top_items("user_top_albums", "album_name")

ORACLE["same_top1_artist"] = with_fixtures("""
SELECT artist_name, CAST(count(DISTINCT user_id) AS BIGINT) AS users_count,
       100.0E0 * count(DISTINCT user_id)
         / greatest((SELECT count(*) FROM (SELECT DISTINCT user_id FROM firsts) u), 1) AS percentage
FROM firsts
GROUP BY artist_name
ORDER BY users_count DESC, artist_name ASC NULLS FIRST
LIMIT 1""", "user_top_artists", ctes=(("firsts", _first_artist()),))

_MENTIONS = ("mentions", """
SELECT artist_name, count(*) AS mentions FROM user_top_artists GROUP BY artist_name""")

ORACLE["artist_mention_stats"] = with_fixtures("""
SELECT 'mean' AS metric, round(CAST(avg(mentions) AS DOUBLE), 6) AS value FROM mentions
UNION ALL
SELECT 'median', CAST(quantile_disc(mentions, 0.5) AS DOUBLE) FROM mentions
UNION ALL
SELECT 'stddev', CAST(round(stddev_samp(mentions), 6) AS DOUBLE) FROM mentions""",
                                           "user_top_artists", ctes=(_MENTIONS,))

ORACLE["long_tail_80"] = with_fixtures("""
SELECT total_artists, artists_in_tail,
       CASE WHEN total_artists > 0
            THEN round(100.0E0 * artists_in_tail / total_artists, 2) ELSE 0.0E0 END AS tail_percentage
FROM agg""", "user_top_artists", ctes=(_MENTIONS, ("ordered", """
SELECT mentions,
       sum(mentions) OVER (ORDER BY mentions DESC
                           RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
FROM mentions"""), ("agg", """
SELECT CAST(count(*) AS BIGINT) AS total_artists,
       CAST(coalesce(sum(CASE WHEN cum <= 0.8E0 * greatest((SELECT sum(mentions) FROM mentions), 1)
                              THEN 1 ELSE 0 END), 0) AS BIGINT) AS artists_in_tail
FROM ordered""")))


# --- counts (M7–M12) --------------------------------------------------------

for _table, _item, _count in (("user_top_artists", "artist_name", "artist_count"),
                              ("user_top_tracks", "track_name", "track_count"),
                              ("user_top_albums", "album_name", "album_count")):
    _counts = (("counts", f"""
SELECT user_id, count(DISTINCT {_item}) AS {_count} FROM {_table} GROUP BY user_id"""),)
    _kind = _count.split("_")[0]
    ORACLE[f"user_{_kind}_counts"] = with_fixtures("SELECT * FROM counts", _table, ctes=_counts)
    ORACLE[f"user_{_kind}_stats"] = with_fixtures(f"""
SELECT 'mean' AS metric, CAST(avg({_count}) AS DOUBLE) AS value FROM counts
UNION ALL
SELECT 'median', CAST(quantile_disc({_count}, 0.5) AS DOUBLE) FROM counts""", _table, ctes=_counts)

ORACLE["unique_items"] = with_fixtures("""
SELECT (SELECT count(*) FROM (SELECT DISTINCT artist_name FROM user_top_artists) a) AS unique_artists,
       (SELECT count(*) FROM (SELECT DISTINCT track_name FROM user_top_tracks) t) AS unique_tracks,
       (SELECT count(*) FROM (SELECT DISTINCT album_name FROM user_top_albums) b) AS unique_albums""",
                                   "user_top_artists", "user_top_tracks", "user_top_albums")

ORACLE["identical_top_lists"] = with_fixtures("""
SELECT top1, top2, top3, user_count FROM (
  SELECT sig, top1, top2, top3, count(user_id) AS user_count
  FROM per_user GROUP BY sig, top1, top2, top3) g
WHERE user_count >= 2
ORDER BY user_count DESC, top1 ASC NULLS FIRST, top2 ASC NULLS FIRST, top3 ASC NULLS FIRST, sig
LIMIT 3""", "user_top_types", ctes=(("ranked", """
SELECT user_id, track_name,
       row_number() OVER (PARTITION BY user_id
                          ORDER BY playcount DESC NULLS LAST, track_name ASC NULLS FIRST) AS rn
FROM user_top_types"""), ("per_user", """
SELECT user_id,
       coalesce(list(track_name ORDER BY rn) FILTER (WHERE track_name IS NOT NULL), []) AS sig,
       max(CASE WHEN rn = 1 THEN track_name END) AS top1,
       max(CASE WHEN rn = 2 THEN track_name END) AS top2,
       max(CASE WHEN rn = 3 THEN track_name END) AS top3
FROM ranked WHERE rn <= 10 GROUP BY user_id""")))

ORACLE["single_artist_top5"] = with_fixtures("""
SELECT user_id, main_artist, track_count FROM (
  SELECT user_id, count(DISTINCT artist_name) AS distinct_artists,
         count(*) AS track_count, max(artist_name) AS main_artist
  FROM ranked WHERE rn <= 5 GROUP BY user_id) g
WHERE track_count = 5 AND distinct_artists = 1""", "user_tracks_by_region", ctes=(("ranked", """
SELECT user_id, track_name, artist_name,
       row_number() OVER (PARTITION BY user_id ORDER BY playcount DESC NULLS LAST,
                          track_name ASC NULLS FIRST, artist_name ASC NULLS FIRST) AS rn
FROM user_tracks_by_region"""),))

# --- co-occurrence and positions (M13–M18) ----------------------------------

_USER_ITEMS = ("ui", """
SELECT DISTINCT user_id, artist_name FROM user_top_artists WHERE artist_name IS NOT NULL""")

ORACLE["artist_pairs"] = with_fixtures("""
SELECT a.artist_name AS artist1, b.artist_name AS artist2, count(*) AS pair_count
FROM ui a JOIN ui b
  ON a.user_id = b.user_id AND a.artist_name < b.artist_name
GROUP BY 1, 2
ORDER BY pair_count DESC, artist1, artist2
LIMIT 50""", "user_top_artists", ctes=(_USER_ITEMS,))

ORACLE["artist_triplets"] = with_fixtures("""
SELECT a.artist_name AS artist1, b.artist_name AS artist2, c.artist_name AS artist3,
       count(*) AS triplet_count
FROM ui10 a
JOIN ui10 b ON a.user_id = b.user_id AND a.artist_name < b.artist_name
JOIN ui10 c ON b.user_id = c.user_id AND b.artist_name < c.artist_name
GROUP BY 1, 2, 3
ORDER BY triplet_count DESC, artist1, artist2, artist3
LIMIT 50""", "user_top_artists", ctes=(("ui10", """
SELECT DISTINCT user_id, artist_name FROM user_top_artists
WHERE artist_name IS NOT NULL AND rank <= 10"""),))

ORACLE["artist_track_overlap"] = with_fixtures("""
SELECT CAST(coalesce(sum(CASE WHEN a.artist_name = t.artist_name THEN 1 ELSE 0 END), 0) AS BIGINT)
         AS overlap_count,
       count(*) AS total_users,
       CASE WHEN count(*) = 0 THEN 0.0E0
            ELSE CAST(coalesce(sum(CASE WHEN a.artist_name = t.artist_name THEN 1 ELSE 0 END), 0)
                      AS DOUBLE) / count(*) END AS overlap_ratio
FROM firsts a JOIN first_tracks t ON a.user_id = t.user_id""", "user_top_artists", "user_top_tracks",
                                           ctes=(("firsts", _first_artist()), ("first_tracks", """
SELECT user_id, artist_name FROM (
  SELECT user_id, artist_name,
         row_number() OVER (PARTITION BY user_id ORDER BY playcount DESC NULLS LAST,
                            track_name ASC NULLS FIRST, artist_name ASC NULLS FIRST) AS rn
  FROM user_top_tracks) r
WHERE rn = 1""")))

ORACLE["artist_average_position"] = with_fixtures("""
SELECT artist_name, CAST(avg(rn) AS DOUBLE) AS avg_position,
       count(DISTINCT user_id) AS user_count
FROM (SELECT user_id, artist_name,
             row_number() OVER (PARTITION BY user_id ORDER BY playcount DESC NULLS LAST,
                                artist_name ASC NULLS FIRST) AS rn
      FROM user_top_artists) r
GROUP BY artist_name
ORDER BY avg_position, artist_name""", "user_top_artists")

ORACLE["top1_in_global_top5"] = with_fixtures("""
SELECT matched_users, total_users,
       CASE WHEN total_users = 0 THEN 0.0E0
            ELSE CAST(matched_users AS DOUBLE) / total_users END AS ratio
FROM (SELECT (SELECT count(*) FROM (SELECT DISTINCT user_id FROM firsts
                                    WHERE artist_name IN (SELECT artist_name FROM top5)) m)
               AS matched_users,
             (SELECT count(*) FROM (SELECT DISTINCT user_id FROM firsts) u) AS total_users) x""",
                                          "user_top_artists", ctes=(("firsts", _first_artist()), ("top5", """
SELECT artist_name FROM user_top_artists GROUP BY artist_name
ORDER BY count(DISTINCT user_id) DESC, artist_name ASC NULLS FIRST LIMIT 5""")))

ORACLE["position_stability"] = with_fixtures("""
SELECT CAST(coalesce(sum(CASE WHEN p1 IS NOT NULL AND p1 = p2 THEN 1 ELSE 0 END), 0) AS BIGINT)
         AS stable_users,
       count(*) AS total_users,
       CASE WHEN count(*) = 0 THEN 0.0E0
            ELSE CAST(coalesce(sum(CASE WHEN p1 IS NOT NULL AND p1 = p2 THEN 1 ELSE 0 END), 0)
                      AS DOUBLE) / count(*) END AS ratio
FROM (SELECT user_id, max(CASE WHEN rn = 1 THEN artist_name END) AS p1,
             max(CASE WHEN rn = 2 THEN artist_name END) AS p2
      FROM (SELECT user_id, artist_name,
                   row_number() OVER (PARTITION BY user_id ORDER BY playcount DESC NULLS LAST,
                                      track_name ASC NULLS FIRST, artist_name ASC NULLS FIRST,
                                      l_orderkey ASC NULLS FIRST, l_linenumber ASC NULLS FIRST) AS rn
            FROM plays_by_region) r
      WHERE rn <= 2
      GROUP BY user_id) p""", "plays_by_region")

# --- comparisons (M19–M21) --------------------------------------------------

ORACLE["active_user_artists"] = with_fixtures("""
SELECT artist_name, count(DISTINCT user_id) AS active_users
FROM user_top_artists
WHERE user_id IN (SELECT user_id FROM user_top_tracks GROUP BY user_id HAVING count(*) > 40)
GROUP BY artist_name
ORDER BY active_users DESC, artist_name ASC NULLS FIRST""", "user_top_artists", "user_top_tracks")

ORACLE["cross_popularity"] = with_fixtures("""
SELECT coalesce(a.artist_name, t.artist_name) AS artist_name,
       coalesce(a.n, 0) AS mentions_in_artists,
       coalesce(t.n, 0) AS mentions_in_tracks,
       coalesce(t.n, 0) - coalesce(a.n, 0) AS difference
FROM (SELECT artist_name, count(*) AS n FROM user_top_artists GROUP BY artist_name) a
FULL OUTER JOIN (SELECT artist_name, count(*) AS n FROM user_top_tracks GROUP BY artist_name) t
  ON a.artist_name = t.artist_name
ORDER BY difference DESC, artist_name ASC NULLS FIRST""", "user_top_artists", "user_top_tracks")

ORACLE["artist_diversity"] = with_fixtures("""
SELECT u.artist_name, u.distinct_users, t.distinct_tracks
FROM (SELECT artist_name, count(DISTINCT user_id) AS distinct_users
      FROM user_top_artists GROUP BY artist_name) u
JOIN (SELECT artist_name, count(DISTINCT track_name) AS distinct_tracks
      FROM user_top_tracks GROUP BY artist_name) t
  ON u.artist_name = t.artist_name
ORDER BY distinct_users DESC, distinct_tracks DESC, artist_name ASC NULLS FIRST""",
                                       "user_top_artists", "user_top_tracks")

# --- quality (M22–M24) ------------------------------------------------------


def _missing_data(table: str) -> str:
    return with_fixtures(f"""
SELECT 'null_or_empty_field' AS problem,
       (SELECT count(*) FROM (SELECT DISTINCT user_id FROM {table}
                              WHERE artist_name IS NULL OR artist_name = '' OR user_id IS NULL) d)
         AS affected_users
UNION ALL
SELECT 'less_than_20_items',
       (SELECT count(*) FROM (SELECT user_id FROM {table} GROUP BY user_id HAVING count(*) < 20) s)""",
                         table)


ORACLE["data_quality"] = _missing_data("user_artists_dirty")
ORACLE["data_quality_clean"] = _missing_data("user_top_artists")

ORACLE["outlier_users"] = with_fixtures("""
SELECT user_id, items_count,
       CASE WHEN items_count >= (SELECT hi FROM q) THEN 99.0E0 ELSE 1.0E0 END AS percentile
FROM counts
WHERE items_count >= (SELECT hi FROM q) OR items_count <= (SELECT lo FROM q)""", "user_top_artists",
                                    ctes=(("counts", """
SELECT user_id, count(*) AS items_count FROM user_top_artists GROUP BY user_id"""), ("q", """
SELECT CAST(quantile_disc(items_count, 0.01) AS DOUBLE) AS lo,
       CAST(quantile_disc(items_count, 0.99) AS DOUBLE) AS hi
FROM counts""")))

ORACLE["low_coverage_artists"] = with_fixtures("""
SELECT artist_name, count(*) AS mentions FROM user_fine_items
GROUP BY artist_name HAVING count(*) < 5
ORDER BY mentions, artist_name ASC NULLS FIRST""", "user_fine_items")


# --- read side (V1–V10) -----------------------------------------------------


def _of(key: str) -> str:
    return f"({ORACLE[key]}\n) m"


ORACLE["serve_top1_artist"] = f"""
SELECT artist_name AS top1_artist, users_count, percentage FROM {_of("same_top1_artist")}"""

ORACLE["serve_active_page"] = f"""
SELECT * FROM {_of("active_user_artists")}
ORDER BY active_users DESC, artist_name ASC NULLS FIRST LIMIT 20"""

ORACLE["serve_cross_page"] = f"""
SELECT * FROM {_of("cross_popularity")}
ORDER BY difference DESC, artist_name ASC NULLS FIRST LIMIT 20"""

ORACLE["serve_position_page"] = f"""
SELECT * FROM {_of("artist_average_position")}
ORDER BY avg_position, artist_name ASC NULLS FIRST LIMIT 200"""

ORACLE["serve_diversity_page"] = f"""
SELECT * FROM {_of("artist_diversity")}
ORDER BY distinct_users DESC, distinct_tracks DESC, artist_name ASC NULLS FIRST LIMIT 20"""

ORACLE["serve_items_per_user"] = "\nUNION ALL\n".join(f"""
SELECT '{label}' AS item_type,
       (SELECT count(*) FROM {_of(f"user_{kind}_counts")}) AS total_users,
       (SELECT value FROM {_of(f"user_{kind}_stats")} WHERE metric = 'mean') AS mean,
       (SELECT value FROM {_of(f"user_{kind}_stats")} WHERE metric = 'median') AS median"""
    for label, kind in (("artists", "artist"), ("tracks", "track"), ("albums", "album")))

ORACLE["serve_concentrated_users"] = f"""
SELECT * FROM {_of("single_artist_top5")} ORDER BY main_artist, user_id"""

ORACLE["serve_concentrated_artists"] = f"""
SELECT main_artist, count(*) AS user_count FROM {_of("single_artist_top5")}
GROUP BY main_artist ORDER BY user_count DESC, main_artist ASC NULLS FIRST LIMIT 20"""

ORACLE["serve_quality_total"] = f"""
SELECT CAST(coalesce(sum(affected_users), 0) AS BIGINT) AS total FROM {_of("data_quality")}"""

ORACLE["serve_outlier_sample"] = f"""
SELECT CASE WHEN length(CAST(user_id AS VARCHAR)) > 6
            THEN concat(substring(CAST(user_id AS VARCHAR), 1, 6), '…')
            ELSE CAST(user_id AS VARCHAR) END AS user_id,
       items_count, percentile,
       (SELECT count(*) FROM {_of("outlier_users")}) AS total_population
FROM {_of("outlier_users")}
ORDER BY m.user_id ASC NULLS FIRST LIMIT 10"""

ORACLE["serve_low_coverage_sample"] = f"""
SELECT artist_name, mentions,
       (SELECT count(*) FROM {_of("low_coverage_artists")}) AS total_population
FROM {_of("low_coverage_artists")}
ORDER BY mentions, artist_name ASC NULLS FIRST LIMIT 10"""

ORACLE["serve_top3_labels"] = f"""
SELECT concat(coalesce(top1, 'null'), ' / ', coalesce(top2, 'null'), ' / ',
              coalesce(top3, 'null')) AS combo, user_count
FROM {_of("identical_top_lists")}"""

ORACLE["serve_top1_share"] = f"""
SELECT artist_name AS label, CAST(percentage AS DOUBLE) AS share, 100.0E0 - percentage AS remainder
FROM {_of("same_top1_artist")}"""

ORACLE["serve_long_tail_share"] = f"""
SELECT 'artists_in_tail' AS label, CAST(tail_percentage AS DOUBLE) AS share,
       100.0E0 - tail_percentage AS remainder
FROM {_of("long_tail_80")}"""

_NULL_USER = ("nu", """
SELECT CASE WHEN user_id % 50 <> 0 THEN user_id END AS user_id, artist_name, rank FROM user_top_artists""")

ORACLE["pairs_null_user"] = with_fixtures("""
SELECT a.artist_name AS artist1, b.artist_name AS artist2, count(*) AS pair_count
FROM ui a JOIN ui b
  ON a.user_id IS NOT DISTINCT FROM b.user_id AND a.artist_name < b.artist_name
GROUP BY 1, 2 ORDER BY pair_count DESC, artist1, artist2 LIMIT 50""", "user_top_artists",
                                          ctes=(_NULL_USER, ("ui", "SELECT DISTINCT user_id, artist_name FROM nu")))

ORACLE["triplets_null_user"] = with_fixtures("""
SELECT a.artist_name AS artist1, b.artist_name AS artist2, c.artist_name AS artist3, count(*) AS triplet_count
FROM ui a
JOIN ui b ON a.user_id IS NOT DISTINCT FROM b.user_id AND a.artist_name < b.artist_name
JOIN ui c ON b.user_id IS NOT DISTINCT FROM c.user_id AND b.artist_name < c.artist_name
GROUP BY 1, 2, 3 ORDER BY triplet_count DESC, artist1, artist2, artist3 LIMIT 50""", "user_top_artists",
                                             ctes=(_NULL_USER, ("ui", """
SELECT DISTINCT user_id, artist_name FROM nu WHERE rank <= 10""")))

# --- ingest, result store and suite runners (S1–S10, R1–R3) ------------------

# Rows of the export of user_top_artists: good rows, repeated ones, rows without a user;
# those with an extra field or text for a number are malformed.
_EXPORT = ("good", """
SELECT CAST(user_id AS VARCHAR) AS user_id, artist_name, playcount, rank FROM user_top_artists
UNION ALL
SELECT CAST(user_id AS VARCHAR), artist_name, playcount, rank FROM user_top_artists WHERE user_id % 10 = 0
UNION ALL
SELECT NULL, artist_name, playcount, rank FROM user_top_artists WHERE user_id % 11 = 0""")

ORACLE["ingest_clean"] = with_fixtures("""
SELECT DISTINCT user_id, artist_name, playcount, rank FROM good WHERE user_id IS NOT NULL""",
                                       "user_top_artists", ctes=(_EXPORT,))

ORACLE["ingest_backup"] = with_fixtures("""
SELECT user_id, artist_name, CAST(playcount AS VARCHAR) AS playcount, CAST(rank AS VARCHAR) AS rank
FROM good""", "user_top_artists", ctes=(_EXPORT,))

ORACLE["ingest_report"] = with_fixtures("""
SELECT 'user_top_artists.csv' AS file, (SELECT count(*) FROM good) AS original_rows,
       (SELECT count(*) FROM user_top_artists WHERE user_id % 12 = 0)
         + (SELECT count(*) FROM user_top_artists WHERE user_id % 13 = 0) AS malformed_rows,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM good WHERE user_id IS NOT NULL) g) AS cleaned_rows,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM good WHERE user_id IS NOT NULL) g) AS final_rows,
       TRUE AS success
UNION ALL
SELECT 'user_top_tracks.csv', n, 0, n, n, TRUE FROM (SELECT count(*) AS n FROM user_top_tracks) t
UNION ALL
SELECT 'user_top_albums.csv', n, 0, n, n, TRUE FROM (SELECT count(*) AS n FROM user_top_albums) b
UNION ALL
SELECT 'users.csv', n, 0, n, n, TRUE FROM (SELECT count(*) AS n FROM customer) c""",
                                        "user_top_artists", "user_top_tracks", "user_top_albums",
                                        ctes=(_EXPORT,))

ORACLE["ingest_users_inferred"] = """
SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS user_id, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey
FROM customer"""


def _on_list(key: str, fixture: str, made: str) -> str:
    """The metric of ``key`` over the plain list ``made`` instead of its own fixture."""
    return ORACLE[key].replace(f"{fixture} AS ({FIXTURE_SQL[fixture]}", f"{made} AS ({FIXTURE_SQL[made]}"
                               ).replace(fixture, made)


_TRACKS, _ARTISTS = "user_top_tracks", "user_top_artists"
_PLAYS_ORDER = """track_name ASC NULLS FIRST, artist_name ASC NULLS FIRST,
                                      l_orderkey ASC NULLS FIRST, l_linenumber ASC NULLS FIRST"""
SUITE_SQL = {
    "popularity": {"top_20_artists": ORACLE["top_artists"], "top_20_tracks": ORACLE["top_tracks"],
                   "top_20_albums": ORACLE["top_albums"], "same_top1_artist": ORACLE["same_top1_artist"],
                   "artist_mention_stats": ORACLE["artist_mention_stats"], "long_tail_80": ORACLE["long_tail_80"]},
    "quality": {"data_quality": ORACLE["data_quality_clean"], "outlier_users": ORACLE["outlier_users"],
                "low_coverage_artists": _on_list("low_coverage_artists", "user_fine_items", _ARTISTS)},
    "cooccurrence": {"top_50_artist_pairs": ORACLE["artist_pairs"], "top_50_artist_triplets": ORACLE["artist_triplets"],
                     "artist_track_overlap": ORACLE["artist_track_overlap"],
                     "artist_average_position": ORACLE["artist_average_position"],
                     "top1_in_global_top5_frequency": ORACLE["top1_in_global_top5"],
                     "position_stability_users": _on_list("position_stability", "plays_by_region", _ARTISTS).replace(
                         _PLAYS_ORDER, "artist_name ASC NULLS FIRST")},
    "counts": {**{f"user_{k}_{w}": ORACLE[f"user_{k}_{w}"] for k in ("artist", "track", "album")
                  for w in ("counts", "stats")},
               "unique_items": ORACLE["unique_items"],
               "users_same_top3_from_top10": _on_list("identical_top_lists", "user_top_types", _TRACKS),
               "users_top5_single_artist": _on_list("single_artist_top5", "user_tracks_by_region", _TRACKS)},
    "compare": {"top_artists_active_users": ORACLE["active_user_artists"],
                "cross_popularity_artists": ORACLE["cross_popularity"], "artists_diversity": ORACLE["artist_diversity"]},
}


# Columns of the results; those of DOUBLES are compared to four decimals.
_SHAPES = {
    "artist_name users_count percentage": ("top_20_artists", "same_top1_artist"),
    "track_name users_count percentage": ("top_20_tracks",),
    "album_name users_count percentage": ("top_20_albums",),
    "metric value": ("artist_mention_stats", "user_artist_stats", "user_track_stats", "user_album_stats"),
    "total_artists artists_in_tail tail_percentage": ("long_tail_80",),
    "problem affected_users": ("data_quality",),
    "user_id items_count percentile": ("outlier_users",),
    "artist_name mentions": ("low_coverage_artists",),
    "artist1 artist2 pair_count": ("top_50_artist_pairs",),
    "artist1 artist2 artist3 triplet_count": ("top_50_artist_triplets",),
    "overlap_count total_users overlap_ratio": ("artist_track_overlap",),
    "artist_name avg_position user_count": ("artist_average_position",),
    "matched_users total_users ratio": ("top1_in_global_top5_frequency",),
    "stable_users total_users ratio": ("position_stability_users",),
    "user_id artist_count": ("user_artist_counts",),
    "user_id track_count": ("user_track_counts",),
    "user_id album_count": ("user_album_counts",),
    "unique_artists unique_tracks unique_albums": ("unique_items",),
    "top1 top2 top3 user_count": ("users_same_top3_from_top10",),
    "user_id main_artist track_count": ("users_top5_single_artist",),
    "artist_name active_users": ("top_artists_active_users",),
    "artist_name mentions_in_artists mentions_in_tracks difference": ("cross_popularity_artists",),
    "artist_name distinct_users distinct_tracks": ("artists_diversity",),
}
RESULT_COLUMNS = {name: columns.split() for columns, names in _SHAPES.items() for name in names}
DOUBLES = {"percentage", "value", "tail_percentage", "percentile", "overlap_ratio", "avg_position", "ratio"}


def _suite_rows(*groups: str) -> str:
    """(result, rows, content): rows of each result's SQL, and the sum of its rows' hashes."""
    def one(name: str, sql: str) -> str:
        cells = ", ".join(f"coalesce({f'round({c} * 10000)::BIGINT' if c in DOUBLES else c}::VARCHAR, '~')"
                          for c in sorted(RESULT_COLUMNS[name]))
        return (f"SELECT '{name}' AS result, count(*) AS rows, coalesce(sum(('0x' || left(md5(concat_ws('|', {cells})), 8))"
                f"::BIGINT), 0)::BIGINT AS content FROM ({sql}\n) m")
    return "\nUNION ALL\n".join(one(name, sql) for g in groups for name, sql in SUITE_SQL[g].items())


ORACLE["suite_full"] = _suite_rows(*SUITE_SQL)
ORACLE["suite_counts"] = _suite_rows("counts")
ORACLE["suite_compare"] = _suite_rows("compare")
ORACLE["store_sql"] = f"""
SELECT a.artist_name, a.users_count, d.distinct_tracks
FROM ({ORACLE["top_artists"]}
) a JOIN ({ORACLE["artist_diversity"]}
) d ON a.artist_name = d.artist_name"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
