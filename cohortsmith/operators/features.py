"""Per-patient features relative to the index date, long form and wide form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.columns import as_date, count_true, day_diff, efi_category, stage_at


def event_dates(ev: DataFrame, index_date) -> DataFrame:
    """Per (patid, concept): earliest and latest date on/before the index, first date after.

    One pass of conditional aggregates (partial aggregation before the shuffle)."""
    idx = as_date(index_date)
    d = F.col("date")
    return ev.groupBy("patid", "concept").agg(
        F.min(F.when(d <= idx, d)).alias("earliest_pre"),
        F.max(F.when(d <= idx, d)).alias("latest_pre"),
        F.min(F.when(d > idx, d)).alias("first_post"),
    )


def to_wide(long: DataFrame, concepts, templates: dict[str, str], key: str = "patid") -> DataFrame:
    """Pivot a long (key, concept, metrics...) frame to one row per key.

    ``templates`` maps metric column -> output name template with ``{c}``.  The concept list is
    passed explicitly: the schema is fixed by configuration and no extra distinct job runs.
    Output column order: for each concept, the metrics in ``templates`` order."""
    concepts = list(concepts)
    metrics = list(templates)
    # Dates travel as day numbers: Spark's compact PivotFirst aggregate handles numeric types
    # only; a DATE metric would expand into one aggregate per (concept, metric).
    dates = {m for m in metrics if isinstance(long.schema[m].dataType, T.DateType)}
    slim = long.select(key, "concept", *[F.unix_date(m).alias(m) if m in dates else F.col(m) for m in metrics])
    wide = slim.groupBy(key).pivot("concept", concepts).agg(*[F.first(m).alias(m) for m in metrics])
    out = [F.col(key)]
    for c in concepts:
        for m in metrics:
            src = F.col(f"`{c}_{m}`" if len(metrics) > 1 else f"`{c}`")
            out.append((F.date_from_unix_date(src) if m in dates else src).alias(templates[m].format(c=c)))
    return wide.select(*out)


def attach(spine: DataFrame, wide: DataFrame, key: str = "patid") -> DataFrame:
    """Spine LEFT JOIN wide: exactly one row per spine key."""
    return spine.select(key).join(wide, key, "left")


def event_features(ev: DataFrame, spine: DataFrame, index_date, concepts, *,
                   earliest: str, latest: str, post: str, flag: str | None = None) -> DataFrame:
    """Spine + per concept: earliest-pre, latest-pre, [ever-before flag], first-post.

    The flag is ``earliest-pre IS NOT NULL`` computed after the spine join, so it is FALSE
    (never NULL) for patients without events and for concepts without codes."""
    concepts = list(concepts)
    long = event_dates(ev.filter(F.col("concept").isin(concepts)), index_date)
    wide = to_wide(long, concepts, {"earliest_pre": earliest, "latest_pre": latest,
                                    "first_post": post})
    out = attach(spine, wide)
    cols = [F.col("patid")]
    for c in concepts:
        e = F.col(earliest.format(c=c))
        cols += [e, F.col(latest.format(c=c))]
        if flag:
            cols.append(e.isNotNull().alias(flag.format(c=c)))
        cols.append(F.col(post.format(c=c)))
    return out.select(*cols)


def event_flags(ev: DataFrame, spine: DataFrame, index_date, concepts, *,
                flag: str = "pre_index_date_{c}") -> DataFrame:
    """Spine + one Boolean per concept: any event on/before the index date."""
    concepts = list(concepts)
    idx = as_date(index_date)
    pre = (ev.filter(F.col("concept").isin(concepts) & (F.col("date") <= idx))
             .groupBy("patid").pivot("concept", concepts).agg(F.min(F.unix_date("date"))))
    out = attach(spine, pre)
    return out.select("patid", *[F.col(f"`{c}`").isNotNull().alias(flag.format(c=c)) for c in concepts])


def stage_at_index(spine: DataFrame, history: DataFrame, index_date, *,
                   grace: int = C.CKD_GRACE_DAYS) -> DataFrame:
    """Most severe stage first reached on/before index + grace days; its date and day offset."""
    j = spine.select("patid").join(history, "patid", "left")
    cols = {s: F.col(s) for s in C.CKD_STAGES}
    stage = stage_at(cols, index_date, grace)
    date = None
    for s in C.CKD_STAGES:
        date = F.when(stage == s, F.col(s)) if date is None else date.when(stage == s, F.col(s))
    return j.select("patid", stage.alias("preckdstage"), date.alias("preckdstagedate"),
                    day_diff(date, index_date).alias("preckdstagedatediff"))


def frailty_index(ev: DataFrame, spine: DataFrame, index_date, deficits, *,
                  forced=C.EFI_FORCED, denominator: int = C.EFI_DENOMINATOR) -> DataFrame:
    """Electronic frailty index at the index date.

    One flag per deficit list (any event on/before the index); ``forced`` deficits are TRUE
    for everyone; n = number of TRUE flags over ``deficits``; score = n / denominator;
    category by the fixed cut points.  Column names use the short deficit aliases."""
    deficits = list(deficits)
    flags = event_flags(ev, spine, index_date, deficits,
                        flag="pre_index_date_{c}")
    names = {c: "pre_index_date_" + C.efi_short(c) for c in deficits}
    cols: list[Column] = [F.col("patid")]
    for c in deficits:
        v = F.lit(True) if c in forced else F.col(f"pre_index_date_{c}")
        cols.append(v.alias(names[c]))
    for c in forced:
        if c not in deficits:
            cols.append(F.lit(True).alias("pre_index_date_" + C.efi_short(c)))
    x = flags.select(*cols)
    n = count_true([names[c] for c in deficits]) if deficits else F.lit(0)
    score = n.cast("double") / F.lit(float(denominator))
    return x.select("*", n.alias("efi_n_deficits"), score.alias("pre_index_date_efi_score"),
                    efi_category(score).alias("pre_index_date_efi_cat"))
