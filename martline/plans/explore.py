"""Exploration jobs (E1-E17, P16): grain discovery, overlaps, distributions.

Every job is an aggregate or join over whole tables; where the reference
walked rows in Python (sets, counters, loops over files) the equivalent here
is a ``groupBy``, a tagged union or a keyed self-join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martline.functions.text import is_two_letter_code, normalise_key
from martline.operators.sets import presence_matrix, size_histogram, tagged_union
from martline.operators.windows import previous_value


def key_battery(df: DataFrame, candidates: Sequence[Sequence[str]], table: str,
                file_col: str | None = None) -> DataFrame:
    """For each candidate key, the rows beyond the first per key value.

    One ``groupBy(key).count()`` per candidate, each reading only its key
    columns; a candidate naming a missing column is reported as SKIPPED
    (decided on the schema, no job).  Nulls compare equal, like pandas.
    With ``file_col`` the battery runs per file (the key is tested inside
    each file), one row per (file, candidate).
    """
    by = [file_col] if file_col else []
    out = None
    for keys in candidates:
        label = ",".join(keys)
        if not set(keys) <= set(df.columns):
            base = df.select(*by).distinct() if by else df.sparkSession.range(1)
            r = base.select(*by, F.lit(table).alias("table_name"), F.lit(label).alias("key_columns"),
                            F.lit(None).cast("bigint").alias("extra_rows"), F.lit("SKIPPED").alias("status"))
        else:
            g = df.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("_n"))
            r = g.groupBy(*by).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("extra_rows")) \
                .select(*by, F.lit(table).alias("table_name"), F.lit(label).alias("key_columns"), "extra_rows",
                        F.when(F.col("extra_rows") == 0, "UNIQUE").otherwise("DUPLICATES").alias("status"))
        out = r if out is None else out.unionByName(r)
    return out


def overlap_keys(df: DataFrame, file_col: str, keys: Sequence[str], date_col: str) -> DataFrame:
    """Per pair of files, shared key values, byte-identical rows and shared dates.

    One ``groupBy`` per kind of key gathers the files that hold a key value
    (at most one entry per file, combined before the shuffle); pairs of files
    come from that list, so nothing is joined with itself.  Whole rows are
    grouped by the MD5 of their columns.
    """
    data_cols = [c for c in df.columns if c != file_col]
    row_text = F.to_json(F.struct(*[F.col(c) for c in data_cols]), {"ignoreNullFields": "false"})

    def shared(cols, out, source=df):
        files = (source.groupBy(*cols).agg(F.array_sort(F.collect_set(file_col)).alias("_f"))
                 .where(F.size("_f") > 1).groupBy("_f").agg(F.count(F.lit(1)).alias("_n")))
        later = "transform(slice(_f, i + 2, size(_f)), b -> struct(a AS file_a, b AS file_b))"
        pairs = files.select("_n", F.explode(F.flatten(F.expr(f"transform(_f, (a, i) -> {later})"))).alias("_p"))
        return pairs.groupBy("_p.file_a", "_p.file_b").agg(F.sum("_n").alias(out))

    keys_shared = shared(list(keys), "shared_keys")
    rows_shared = shared([F.md5(row_text).alias("_row")], "identical_rows")
    dates_shared = shared([F.to_date(date_col).alias("_d")], "shared_dates", df.where(F.col(date_col).isNotNull()))
    out = None
    for part, name in ((keys_shared, "shared_keys"), (rows_shared, "identical_rows"), (dates_shared, "shared_dates")):
        wide = part.select("file_a", "file_b", *[(F.col(name) if name == n else F.lit(0).cast("bigint")).alias(n)
                                                 for n in ("shared_keys", "identical_rows", "shared_dates")])
        out = wide if out is None else out.unionByName(wide)
    return out.groupBy("file_a", "file_b").agg(*[F.sum(n).alias(n) for n in ("shared_keys", "identical_rows", "shared_dates")])


def distinct_per_day(df: DataFrame, date_col: str, counts: Mapping[str, str]) -> DataFrame:
    """Distinct counts per day (e.g. sessions and users) plus rows."""
    return df.groupBy(F.to_date(date_col).alias("date")).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_distinct(c).alias(o) for o, c in counts.items()])


def basket_distribution(txn: DataFrame, order_col: str = "order_id") -> DataFrame:
    """E5/A10: number of orders per basket size (line items per order)."""
    return size_histogram(txn, order_col, "line_items").withColumnRenamed("groups", "orders")


def order_values(txn: DataFrame, order_col: str = "order_id", value_col: str = "line_revenue",
                 digits: int = 2) -> DataFrame:
    """Value per order, then min / mean / max over orders."""
    per = txn.groupBy(order_col).agg(F.sum(value_col).alias("_v"))
    return per.agg(F.count(F.lit(1)).alias("orders"), F.round(F.min("_v").cast("double"), digits).alias("min_value"),
                   F.round(F.avg(F.col("_v").cast("double")), digits).alias("avg_value"),
                   F.round(F.max("_v").cast("double"), digits).alias("max_value"))


def recycled_ids(df: DataFrame, id_col: str, file_col: str, date_col: str, value_col: str, file_a: str, file_b: str) -> DataFrame:
    """Ids present in two files, with the first row's date and value in each.

    The first row is the one with the smallest date (then value): a table has
    no row order of its own.
    """
    first = df.groupBy(file_col, id_col).agg(F.min(F.struct(F.col(date_col).alias("d"), F.col(value_col).alias("v"))).alias("_r"))

    def side(name, tag):
        return first.where(F.col(file_col) == name).select(id_col, F.col("_r.d").alias(f"first_date_{tag}"),
                                                           F.col("_r.v").alias(f"{value_col}_{tag}"))
    return side(file_a, "a").join(side(file_b, "b"), id_col, "inner")


def follower_series(posts: DataFrame) -> DataFrame:
    """Per day the first follower count by post id, the previous day's
    value, whether it decreased, and how many distinct values the day had."""
    day = posts.groupBy("date").agg(
        F.min_by("followers", F.struct("post_id", "followers")).alias("followers"),
        F.count_distinct("followers").alias("distinct_values"))
    s = previous_value(day, "followers", "date", out="prev_followers")
    return s.withColumn("decreased", F.coalesce(F.col("followers") < F.col("prev_followers"), F.lit(False)))


def release_vs_mention(mentions: DataFrame) -> DataFrame:
    """Mentions on the release day vs later/earlier."""
    same = F.col("episode_release_date") == F.to_date("mention_datetime")
    return mentions.agg(F.count(F.lit(1)).alias("mentions"), F.count_if(same).alias("same_day"),
                        F.count_if(~same).alias("different_day"))


def multi_mentions(mentions: DataFrame) -> DataFrame:
    """Per show its episodes, and the (show, episode) groups with more than one mention."""
    g = mentions.groupBy("podcast_name", "episode_title").agg(F.count(F.lit(1)).alias("_n"))
    per_show = g.groupBy("podcast_name").agg(F.count_distinct("episode_title").alias("episodes"),
                                             F.count_if(F.col("_n") > 1).alias("multi_mention_groups"),
                                             F.max("_n").alias("max_mentions"))
    return per_show


def promo_crosstab(txn: DataFrame) -> DataFrame:
    """Promo flag x (discount > 0), with negative-revenue rows."""
    return txn.groupBy("promo_flag", (F.col("discount_per_unit") > 0).alias("has_discount")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("line_revenue") < 0).alias("negative_rows"))


def spine_coverage(streams: Mapping[str, DataFrame], date_col: str = "date") -> DataFrame:
    """Per stream its date range, days present and days missing inside it."""
    u = tagged_union(streams, [date_col], "stream").select("stream", F.to_date(date_col).alias("d"))
    d = u.distinct()
    g = d.groupBy("stream").agg(F.min("d").alias("min_date"), F.max("d").alias("max_date"),
                                F.count(F.lit(1)).alias("days_present"))
    return g.withColumn("missing_days", F.datediff("max_date", "min_date") + 1 - F.col("days_present"))


def near_match(values: DataFrame, value_col: str, norm: Column | None = None) -> DataFrame:
    """Raw values whose normalised key is shared by more than one distinct raw value."""
    key = norm if norm is not None else normalise_key(F.col(value_col))
    d = values.select(F.col(value_col).alias("raw"), key.alias("norm_key")).where(F.col("raw").isNotNull())
    g = d.groupBy("norm_key", "raw").agg(F.count(F.lit(1)).alias("_n"))
    # one row per raw variant (no per-key list: a key may gather many variants)
    variants = g.groupBy("norm_key").agg(F.count(F.lit(1)).alias("variants")).where(F.col("variants") > 1)
    return g.join(variants, "norm_key").select("norm_key", "raw", "variants", F.col("_n").alias("n_rows"))


def value_presence(streams: Mapping[str, DataFrame], value_col: str) -> DataFrame:
    """Which streams each value occurs in."""
    u = tagged_union(streams, [value_col], "stream")
    return presence_matrix(u, value_col, "stream", sorted(streams))


def state_format(streams: Mapping[str, DataFrame], col: str = "state") -> DataFrame:
    """Distinct values per stream: two capital letters are a code, longer values a full name."""
    u = tagged_union(streams, [col], "stream")
    code = F.coalesce(is_two_letter_code(F.col(col)), F.lit(False))
    return u.groupBy("stream", col).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("is_code", code).withColumn(
        "is_full_name", F.coalesce(F.length(col) > 2, F.lit(False)))


# Geographic terms searched in show names.
US_STATES = (
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado", "Connecticut", "Delaware", "Florida", "Georgia", "Hawaii",
    "Idaho", "Illinois", "Indiana", "Iowa", "Kansas", "Kentucky", "Louisiana", "Maine", "Maryland", "Massachusetts", "Michigan",
    "Minnesota", "Mississippi", "Missouri", "Montana", "Nebraska", "Nevada", "New Hampshire", "New Jersey", "New Mexico", "New York",
    "North Carolina", "North Dakota", "Ohio", "Oklahoma", "Oregon", "Pennsylvania", "Rhode Island", "South Carolina", "South Dakota",
    "Tennessee", "Texas", "Utah", "Vermont", "Virginia", "Washington", "West Virginia", "Wisconsin", "Wyoming",
)
CITIES = (
    "Atlanta", "ATL", "Nashville", "Charlotte", "Dallas", "Houston", "Miami", "Tampa", "Raleigh", "Savannah", "Charleston", "Memphis",
    "Birmingham", "Jacksonville", "New Orleans", "Austin", "San Antonio", "Richmond", "Louisville", "Knoxville", "Chattanooga",
    "Greenville", "Columbia", "Macon", "Augusta", "Athens",
)
REGIONAL = (
    "Southern", "Peach State", "Dixie", "Deep South", "Magnolia", "Gulf Coast", "Low Country", "Lowcountry", "Bible Belt", "Sun Belt",
    "Sunbelt",
)
STATE_ABBREVS = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI",
    "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT",
    "VT", "VA", "WA", "WV", "WI", "WY",
)
# abbreviations and city names of up to three letters are whole words in
# their own case; all other terms match anywhere in any case
GEO_TERMS = (
    *(("state", t, "substring") for t in US_STATES),
    *(("city", t, "word" if len(t) <= 3 else "substring") for t in CITIES),
    *(("regional", t, "substring") for t in REGIONAL),
    *(("abbrev", t, "word") for t in STATE_ABBREVS),
)


def geo_signals(mentions: DataFrame, terms: DataFrame) -> DataFrame:
    """Per show, the geographic terms its name matches (as kind:term), its
    mentions and the distinct episodes that mention the founder."""
    from martline.operators.joins import term_matches
    hits = term_matches(mentions, "podcast_name", terms).groupBy("text").agg(
        F.concat_ws(",", F.array_sort(F.collect_set(F.concat_ws(":", "kind", "term")))).alias("geo_terms"))
    episode = F.when(F.col("mentions_founder") == 1, F.coalesce("episode_title", F.lit("")))
    per_show = mentions.where(F.col("podcast_name").isNotNull()).groupBy("podcast_name").agg(
        F.count(F.lit(1)).alias("mentions"), F.count_distinct(episode).alias("founder_episodes"))
    j = per_show.join(hits, per_show.podcast_name == hits.text, "left").drop("text")
    return j.withColumn("is_geo", F.col("geo_terms").isNotNull()).withColumn("has_founder", F.col("founder_episodes") > 0)


def geo_summary(signals: DataFrame) -> DataFrame:
    """Number of shows by geographic reference and founder mention."""
    return signals.groupBy("is_geo", "has_founder").agg(F.count(F.lit(1)).alias("shows"))


def metric_distribution(df: DataFrame, group: str, metric: str, digits: int = 2) -> DataFrame:
    """Count, min, max, mean, median and sample stdev per group."""
    from martline.operators.quantiles import exact_median, join_median
    v = F.col(metric).cast("double")
    stats = df.groupBy(group).agg(
        F.count(v).alias("n"), F.round(F.min(v), digits).alias("min"), F.round(F.max(v), digits).alias("max"),
        F.round(F.avg(v), digits).alias("mean"), F.round(F.stddev_samp(v), digits).alias("stdev"))
    med = exact_median(df, [group], metric, "_med")
    return join_median(stats, med, group).select(group, "n", "min", "max", "mean",
                                                 F.round("_med", digits).alias("median"), "stdev")


def stable_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """A deterministic sample of ``n`` rows (MD5 of seed and keys, so any engine finds the same rows).

    ``orderBy(...).limit(n)`` plans as a per-partition top-n plus a merge,
    so no partition is sorted whole and only ``n`` rows per task move.
    """
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]))
    rest = [c for c in df.columns if c not in keys]  # full tie-break: the same rows on every run
    return df.withColumn("_h", h).orderBy("_h", *keys, *rest).limit(n).drop("_h")



def distinct_values(tables: Mapping[str, DataFrame], col: str) -> DataFrame:
    """Sorted-unique inventory of a column per table, as rows (no collected arrays)."""
    u = tagged_union(tables, [col], "table_name")
    return u.where(F.col(col).isNotNull()).groupBy("table_name", col).agg(F.count(F.lit(1)).alias("n_rows"))


def missing_dates(streams: Mapping[str, DataFrame], date_col: str = "date") -> DataFrame:
    """For each stream, the days inside its own range that it lacks.

    The gaps between successive distinct dates are laid out as days, so no
    calendar is joined with the streams.
    """
    u = tagged_union(streams, [date_col], "stream").select("stream", F.to_date(date_col).alias("d")).where(F.col("d").isNotNull()).distinct()
    later = F.lead("d").over(Window.partitionBy("stream").orderBy("d"))
    gaps = u.withColumn("_next", later).where(F.datediff("_next", "d") > 1)
    return gaps.select("stream", F.explode(F.sequence(F.date_add("d", 1), F.date_sub("_next", 1))).alias("date"))


def union_coverage(streams: Mapping[str, DataFrame], date_col: str = "date") -> DataFrame:
    """First and last day of all streams, days in that range, with data and without any."""
    u = tagged_union(streams, [date_col], "stream").select(F.to_date(date_col).alias("d"))
    g = u.agg(F.min("d").alias("min_date"), F.max("d").alias("max_date"), F.count_distinct("d").alias("days_with_data"))
    days = F.datediff("max_date", "min_date") + 1
    return g.select("min_date", "max_date", days.cast("bigint").alias("days_in_range"), "days_with_data",
                    (days - F.col("days_with_data")).cast("bigint").alias("days_without_data"))


def airport_inventory(weekly: DataFrame) -> DataFrame:
    """Each airport code with its most recent name and its number of weeks."""
    return weekly.groupBy("airport_code").agg(F.max_by("airport_name", F.struct("week_start_date", "airport_name")).alias("airport_name"),
                                              F.count(F.lit(1)).alias("weeks"))


def id_name_map(df: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """Each id with its name (latest by name order) and how many distinct names it carries."""
    return df.groupBy(id_col).agg(F.max(name_col).alias(name_col), F.count_distinct(name_col).alias("names"),
                                  F.count(F.lit(1)).alias("n_rows"))


# Words that mark a column name as geographic.
GEO_WORDS = ("state", "dma", "city", "region", "geo", "zip", "location")


def geo_columns(tables: Mapping[str, DataFrame], words: Sequence[str] = GEO_WORDS) -> list[tuple[str, str]]:
    """(table, column) pairs whose column name contains a geographic word (schema only)."""
    return [(t, c) for t in sorted(tables) for c in tables[t].columns
            if any(w in c.lower() for w in words)]
