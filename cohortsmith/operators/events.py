"""Coded-event extraction and event-level cleaning.

Long event frames carry ``patid, concept, date`` (+ ``value``/``numunitid``/``code``/
``source`` where relevant).  All concepts travel in one frame; ``concept`` is a
grouping key, never a driver-side loop over Spark jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import day_diff, isin_strict
from .joins import prefix_join


def select_codes(codelists: DataFrame, *, code_system: str | None = None, version=None,
                 concepts=None) -> DataFrame:
    codes = codelists
    if version is not None:
        codes = codes.filter(F.col("version") == F.lit(version))
    if code_system is not None:
        codes = codes.filter(F.col("code_system") == code_system)
    if concepts is not None:
        codes = codes.filter(F.col("concept").isin(list(concepts)))
    return codes


def extract_events(events: DataFrame, codes: DataFrame, *, code_col: str, date_col: str,
                   keep=(), code_alias: str | None = None) -> DataFrame:
    """One scan of ``events`` joined to *all* requested codelists at once.

    ``codes`` is a (concept, code [, tags...]) table; a code in several lists yields one row
    per list; extra code-table columns (e.g. a ``family`` tag) are carried to the output.
    The codelist side is broadcast when its size in bytes is under Spark's threshold.
    Output: patid, concept, date, *tags, *keep [, code].
    """
    extra = [c for c in codes.columns if c not in ("code", "concept", "version", "code_system")]
    c = codes.select(F.col("code").alias("_code"), "concept", *extra)
    joined = events.join(c, events[code_col] == F.col("_code"))
    out = [F.col("patid"), F.col("concept"), F.col(date_col).alias("date"), *[F.col(x) for x in extra]]
    out += [F.col(k) if isinstance(k, str) else k for k in keep]
    if code_alias:
        out.append(F.col(code_col).alias(code_alias))
    return joined.select(*out)


def restrict_to_registration(ev: DataFrame, valid: DataFrame, *, start_col: str = "min_dob",
                             end_col: str = "gp_end_date", date_col: str = "date") -> DataFrame:
    """Keep events with ``start <= date <= end`` of the patient's valid period (NULL bound drops).

    ``valid`` has one row per patient; this is an equi join on patid with an interval
    residual, planned as a shuffle join at scale (AQE splits hot patients)."""
    v = valid.select("patid", F.col(start_col).alias("_lo"), F.col(end_col).alias("_hi"))
    return (ev.join(v, "patid")
              .filter(F.col(date_col).between(F.col("_lo"), F.col("_hi")))
              .drop("_lo", "_hi"))


def restrict_dates(ev: DataFrame, valid: DataFrame, *, late_end: str = "late") -> DataFrame:
    """Distinct (patid, concept, date) inside the patient's valid period.

    Features need dates only, so equal rows go first: a combine on the map side, after which a
    patient has at most one row per concept and day, however many rows it had.  Rows whose
    Boolean ``late_end`` is TRUE end at gp_ons_end_date, the others at gp_end_date: one join for
    all prescription families."""
    slim = ev.select("patid", "concept", "date", F.col(late_end).alias("_late")).distinct()
    v = valid.select("patid", "min_dob", "gp_end_date", "gp_ons_end_date")
    end = F.when(F.col("_late"), F.col("gp_ons_end_date")).otherwise(F.col("gp_end_date"))
    return (slim.join(v, "patid").filter((F.col("date") >= F.col("min_dob")) & (F.col("date") <= end))
                .select("patid", "concept", "date"))


def with_datediff(ev: DataFrame, index_date, date_col: str = "date") -> DataFrame:
    """Every event with its signed day relative to the index date."""
    return ev.withColumn("datediff", day_diff(F.col(date_col), index_date))


def tag_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Union of code sources (each: patid, concept, date, code) with a ``source`` tag."""
    out = None
    for name, df in sources.items():
        tagged = df.select("patid", "concept", "date", "code", F.lit(name).alias("source"))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def restrict_by_source(ev: DataFrame, valid: DataFrame, *, hospital: bool = False) -> DataFrame:
    """Source-dependent validity.

    Active rule: ``date >= min_dob AND source = 'gp' AND date <= gp_end_date`` (hospital rows
    never survive).  ``hospital=True`` is the wider rule: GP rows up to gp_ons_end_date and
    hospital rows up to the death date (or any date when alive)."""
    v = valid.select("patid", "min_dob", "gp_end_date", "gp_ons_end_date", "gp_ons_death_date")
    d, s = F.col("date"), F.col("source")
    if hospital:
        cond = ((s == "gp") & (d <= F.col("gp_ons_end_date"))) | (
            s.isin("hes_icd10", "hes_opcs4")
            & (F.col("gp_ons_death_date").isNull() | (d <= F.col("gp_ons_death_date"))))
    else:
        cond = (s == "gp") & (d <= F.col("gp_end_date"))
    return ev.join(v, "patid").filter((d >= F.col("min_dob")) & cond).select(*ev.columns)


def class_codelist(lookup: DataFrame, *, classes, subclasses, code_col: str = "prodcodeid") -> DataFrame:
    """Drug-class lookup as a (concept, code) list: a product belongs to its class and (if
    listed) to its sub-class.  Explodes (kind, name) pairs so a sub-class name can never match
    a class name.  Works on the small lookup, never on the prescription table."""
    pairs = F.array(
        F.struct(F.lit("class").alias("kind"), F.col("drug_class_1").alias("name")),
        F.struct(F.lit("sub").alias("kind"), F.col("drug_substance_2").alias("name")))
    x = lookup.select(F.col(code_col).alias("code"), F.explode(pairs).alias("p"))
    keep = (((F.col("p.kind") == "class") & isin_strict(F.col("p.name"), classes))
            | ((F.col("p.kind") == "sub") & isin_strict(F.col("p.name"), subclasses)))
    return x.filter(keep).select(F.col("p.name").alias("concept"), "code")


def split_drug_classes(scripts: DataFrame, lookup: DataFrame, *, classes, subclasses,
                       code_col: str = "prodcodeid", date_col: str = "date") -> DataFrame:
    """Scripts of the listed classes and sub-classes: one join of the scripts to the lookup
    turned into a codelist.  Output: patid, concept, date."""
    codes = class_codelist(lookup, classes=classes, subclasses=subclasses)
    return extract_events(scripts, codes, code_col=code_col, date_col=date_col)


def hospital_diagnoses(hosp: DataFrame, codes: DataFrame, *, exclude=("hypertension",)) -> DataFrame:
    """Hospital ICD-10 events matched by code *prefix* (``ICD LIKE prefix%``).

    ``codes``: icd10 lists named ``icd10_<concept>``; the concept keeps the bare name.
    The lists are bounded by the classification, whatever the number of events, so they are
    broadcast: the size of a filtered catalogue is known only after the events were exchanged.
    Output: patid, concept, date, code (full ICD), prefix, d_order."""
    c = (codes.select(F.regexp_replace("concept", "^icd10_", "").alias("concept"),
                      F.col("code").alias("prefix"))
              .filter(~F.col("concept").isin(list(exclude))))
    j = prefix_join(hosp, "ICD", F.broadcast(c), "prefix")
    return j.select("patid", "concept", F.col("epistart").alias("date"),
                    F.col("ICD").alias("code"), "prefix", "d_order")


def hospital_procedures(proc: DataFrame, codes: DataFrame) -> DataFrame:
    """Hospital OPCS-4 events, equi join on differing key names (OPCS = opcs4 code).

    The lists are broadcast, as those of ``hospital_diagnoses``."""
    c = codes.select(F.regexp_replace("concept", "^opcs4_", "").alias("concept"),
                     F.col("code").alias("opcs4"))
    j = proc.join(F.broadcast(c), proc["OPCS"] == F.col("opcs4"))
    return j.select("patid", "concept", F.col("evdate").alias("date"), F.col("OPCS").alias("code"))


def primary_cause(hosp_events: DataFrame, concept: str, new_concept: str) -> DataFrame:
    """Hospital rows of ``concept`` with ``d_order == 1`` relabelled as ``new_concept``."""
    return (hosp_events.filter((F.col("concept") == concept) & (F.col("d_order") == 1))
                       .withColumn("concept", F.lit(new_concept)))
