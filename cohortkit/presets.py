"""The reference workload expressed with cohortkit operators.

Cleaning of job postings, tag bridge, layoff events and coded labour series,
the cohort tag of postings by layoff membership, and the result queries
(median by level, level share, top tags, tag-set share, remote rate, top
states, the two series views).  Each function takes and returns DataFrames;
the raw inputs are all-string frames as read by ``sources.read_quoted_csv``
/ ``sources.read_padded_tsv``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortkit.functions import clean
from cohortkit.operators import cohort, keys, measures, profile, rules, series
from cohortkit.sources import files, sinks

# --- fixed values (must equal the reference for identical results) ---------
POSTING_COLUMNS = [
    "job_id", "company_id", "company_name", "title", "location", "formatted_work_type",
    "formatted_experience_level", "remote_allowed", "min_salary", "max_salary", "med_salary",
    "pay_period", "normalized_salary", "currency", "views", "applies", "original_listed_time", "zip_code",
]
LAYOFF_COLUMNS = ["company", "location", "total_laid_off", "date", "percentage_laid_off", "industry", "stage",
                  "country"]
SALARY_BOUNDS = (10000, 1000000)
TECH_SKILLS = ["ENG", "IT", "ANLS", "PRDM"]
EXPERIENCE_ORDER = ["Internship", "Entry level", "Associate", "Mid-Senior level", "Director", "Executive"]
COHORT_LABELS = ("layoff_affected", "non_affected")
TOP_K = 10
SERIES_HEADER = ["series_id", "year", "period", "value", "footnote_codes"]
# ---------------------------------------------------------------------------

POSTING_NUMERICS = ["min_salary", "max_salary", "med_salary", "normalized_salary", "views", "applies"]


def typed_postings(raw: DataFrame) -> DataFrame:
    """Derived columns and typed numerics of the raw postings."""
    df = raw.select(*POSTING_COLUMNS)
    return df.select(
        *[c for c in POSTING_COLUMNS if c not in POSTING_NUMERICS + ["remote_allowed", "zip_code"]],
        *[clean.to_double(c).alias(c) for c in POSTING_NUMERICS],
        clean.to_flag("remote_allowed").alias("remote_allowed"),
        F.col("zip_code").cast("string").alias("zip_code"),
        clean.split_part("location", 0).alias("city"),
        clean.split_part("location", 1).alias("state"),
        clean.epoch_millis_to_date("original_listed_time").alias("listed_date"),
        clean.canonical_key("company_name").alias("company_normalized"),
    )


def posting_rules() -> list[rules.Rule]:
    return [rules.Rule("min_salary_gt_max_salary", rules.inverted_range("min_salary", "max_salary")),
            rules.Rule("normalized_salary_out_of_bounds", rules.out_of_bounds("normalized_salary", *SALARY_BOUNDS))]


def clean_postings(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(postings, audit)``: derived columns, typed numerics, the two ordered drop rules."""
    return rules.clean_with_audit(typed_postings(raw), posting_rules(), "postings_clean")


def typed_layoffs(raw: DataFrame) -> DataFrame:
    """Lenient date and numbers and the company key of the raw layoff events."""
    return raw.select(*LAYOFF_COLUMNS).select(
        "company", "location", clean.to_int("total_laid_off").alias("total_laid_off"),
        clean.parse_date("date").alias("date"), clean.to_double("percentage_laid_off").alias("percentage_laid_off"),
        "industry", "stage", "country", clean.canonical_key("company").alias("company_normalized"))


def layoff_rules() -> list[rules.Rule]:
    return [rules.Rule("both_laid_off_fields_null", rules.all_null(["total_laid_off", "percentage_laid_off"]))]


def clean_layoffs(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(layoffs, audit)``: lenient date and numbers, company key, drop rows with both measures NULL."""
    return rules.clean_with_audit(typed_layoffs(raw), layoff_rules(), "layoffs_clean")


def _skill_pairs(job_skills: DataFrame, skills: DataFrame) -> DataFrame:
    """``job_id, skill_abr, skill_name`` with the joined ``rows`` of the pair and how many of them are ``named``."""
    joined = job_skills.select("job_id", "skill_abr").join(skills.select("skill_abr", "skill_name"), "skill_abr", "left")
    return joined.groupBy("job_id", "skill_abr").agg(
        F.min("skill_name").alias("skill_name"), F.count(F.lit(1)).alias("rows"), F.count("skill_name").alias("named"))


def _skill_counts() -> list[Column]:
    kept = F.count_if(F.col("named") > 0)
    return [F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("post_join_row_count"),
            F.coalesce(F.sum("rows") - F.sum("named"), F.lit(0)).cast("bigint").alias("dropped_orphaned_skill_codes"),
            F.coalesce(F.sum("named") - kept, F.lit(0)).cast("bigint").alias("dropped_duplicate_job_skill_pairs"), kept.alias("row_count")]


def _bridge(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("named") > 0).drop("rows", "named")


def clean_skills(job_skills: DataFrame, skills: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(bridge, audit)``: lookup join, orphan codes dropped, one row per (job_id, skill_abr)."""
    pairs = _skill_pairs(job_skills, skills)
    bridge, audit = _bridge(pairs), pairs.agg(*_skill_counts())
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value"))
                                  for c in audit.columns])).alias("m")
    return bridge, audit.select(stacked).select(F.lit("skills_clean").alias("dataset"), "m.metric", "m.value")


def clean_series(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(series, audit)`` from the trimmed raw rows of the three series files."""
    rs = series.series_rules()
    return series.decode(rules.apply_rules(raw, rs)), rules.audit(raw, rs, "series_clean")


def write_clean_tables(raw: dict[str, DataFrame], out_dir: str) -> tuple[dict[str, str], dict[str, DataFrame]]:
    """Write the four clean tables below ``out_dir``; ``(paths, audits)`` by table name.

    Each raw table is scanned once: its audit is gathered by the job that
    writes it, the bridge's on its grouped pairs.
    """
    paths = {n: f"{out_dir}/{n}" for n in ("postings", "layoffs", "skills", "jolts")}
    series_rules = series.series_rules()
    audits = {
        "postings": rules.write_clean(typed_postings(raw["postings"]), posting_rules(), "postings_clean", paths["postings"]),
        "layoffs": rules.write_clean(typed_layoffs(raw["layoffs"]), layoff_rules(), "layoffs_clean", paths["layoffs"]),
        "jolts": rules.write_clean(raw["jolts"], series_rules, "series_clean", paths["jolts"], then=series.decode),
    }
    seen = Observation()
    sinks.write_parquet(_bridge(_skill_pairs(raw["job_skills"], raw["skills"]).observe(seen, *_skill_counts())), paths["skills"])
    return paths, audits | {"skills": rules.observed_rows(raw["skills"], "skills_clean", seen)}


def tag_postings(postings: DataFrame, layoffs: DataFrame) -> DataFrame:
    """Postings with ``subcohort``; aliases applied on the postings side; NULL keys removed."""
    p = keys.apply_aliases(postings, "company_normalized", keys.REFERENCE_ALIASES)
    m = cohort.members(layoffs, "company_normalized", ["total_laid_off", "percentage_laid_off"])
    return cohort.tag(p, m, "company_normalized", labels=COHORT_LABELS, cohort_col="subcohort")


def median_salary_by_level(tagged: DataFrame) -> DataFrame:
    t = tagged.filter((F.col("currency") == "USD") & F.col("formatted_experience_level").isNotNull())
    m = measures.group_median(t.withColumnRenamed("formatted_experience_level", "experience_level"),
                              ["subcohort", "experience_level"], "normalized_salary", out="median_salary",
                              count_col="posting_count")
    return m.orderBy("experience_level", "subcohort")


def tag_posting_counts(postings: DataFrame, layoffs: DataFrame, by: list[str]) -> DataFrame:
    """Postings counted (``n``) per company and the columns ``by``, then tagged.

    For the measures that count rows (``weight="n"``): a company with very
    many postings is a few rows before the join.
    """
    p = keys.apply_aliases(postings, "company_normalized", keys.REFERENCE_ALIASES)
    counts = cohort.key_counts(p, "company_normalized", {c: F.col(c) for c in by})
    m = cohort.members(layoffs, "company_normalized", ["total_laid_off", "percentage_laid_off"])
    return cohort.tag(counts, m, "company_normalized", labels=COHORT_LABELS, cohort_col="subcohort")


def experience_level_share(tagged: DataFrame, weight: str | None = None) -> DataFrame:
    s = measures.category_share(tagged, "subcohort", "formatted_experience_level", "experience_level",
                                keep=F.col("formatted_experience_level").isNotNull(), weight=weight)
    return s.withColumnRenamed("pct_of_cohort", "pct_of_subcohort").orderBy("experience_level", "subcohort")


def top_skills(tagged: DataFrame, bridge: DataFrame, k: int = TOP_K) -> DataFrame:
    per_job = tagged.select("job_id", "subcohort")
    j = per_job.join(bridge.select("job_id", "skill_name"), "job_id", "inner")
    t = measures.top_k(j, "subcohort", "skill_name", k=k)
    return (t.withColumnRenamed("pct_of_cohort", "pct_of_subcohort")
            .select("subcohort", "skill_name", "n", "pct_of_subcohort").orderBy("subcohort", F.desc("n")))


def tech_skill_share(tagged: DataFrame, bridge: DataFrame) -> DataFrame:
    j = tagged.select("job_id", "subcohort").join(bridge.select("job_id", "skill_abr"), "job_id", "inner")
    r = measures.set_rate(j, "subcohort", "skill_abr", TECH_SKILLS, prefix="tech_skill_tags")
    return r.select("subcohort", F.col("total").alias("total_skill_tags"), "tech_skill_tags_n",
                    F.col("tech_skill_tags_pct").alias("tech_pct")).withColumnRenamed(
        "tech_skill_tags_n", "tech_skill_tags").orderBy("subcohort")


def remote_rate(tagged: DataFrame, weight: str | None = None) -> DataFrame:
    r = measures.flag_rate(tagged, "subcohort", F.col("remote_allowed"), prefix="remote", weight=weight)
    return r.select("subcohort", F.col("total").alias("total_postings"), F.col("remote_n").alias("remote_postings"),
                    F.col("remote_pct")).orderBy("subcohort")


def top_states(tagged: DataFrame, k: int = TOP_K, weight: str | None = None) -> DataFrame:
    keep = F.col("state").isNotNull() & (F.col("state") != "")
    t = measures.top_k(tagged, "subcohort", "state", k=k, keep=keep, weight=weight)
    return (t.withColumnRenamed("pct_of_cohort", "pct_of_subcohort")
            .select("subcohort", "state", "n", "pct_of_subcohort").orderBy("subcohort", F.desc("n")))


def layoff_rate_series(series_df: DataFrame) -> DataFrame:
    return series.select_metric(series_df, "layoffs_discharges_rate")


def openings_hires_series(series_df: DataFrame) -> DataFrame:
    return series.pivot_metrics(series_df, ["job_openings_rate", "hires_rate"])


# --- profiles, diagnostic and the whole run --------------------------------
def read_postings(spark: SparkSession, path: str) -> DataFrame:
    return files.read_quoted_csv(spark, path)


def read_jolts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The three series files (openings, hires, layoffs) as one raw table."""
    return files.read_series(spark, paths, SERIES_HEADER, ["series_id", "year", "period", "value"])


def profile_postings(raw: DataFrame) -> DataFrame:
    return profile.table_profile(raw, "postings_raw", ["formatted_work_type", "formatted_experience_level", "currency"],
                                 POSTING_NUMERICS)


def profile_layoffs(raw: DataFrame) -> DataFrame:
    return profile.table_profile(raw, "layoffs_raw", ["industry", "stage", "country"],
                                 ["total_laid_off", "percentage_laid_off"], blank_is_null=True)


def profile_skills(job_skills: DataFrame, skills: DataFrame) -> DataFrame:
    return profile.table_profile(job_skills, "job_skills_raw", ["skill_abr"]).unionByName(
        profile.table_profile(skills, "skills_raw", ["skill_abr"]))


def profile_series(raw: DataFrame) -> DataFrame:
    return profile.table_profile(raw, "jolts_raw", ["series_id", "year", "period"])


def join_diagnostic(postings: DataFrame, layoffs: DataFrame) -> DataFrame:
    """Join viability of postings and layoffs as ``(position, metric, value)``."""
    p = keys.apply_aliases(postings, "company_normalized", keys.REFERENCE_ALIASES)
    return cohort.join_diagnostic(p, layoffs, "company_normalized", "company_normalized")


def run(spark: SparkSession, postings_csv: str, job_skills_csv: str, skills_csv: str, layoffs_csv: str,
        series_files: list[str], out_dir: str) -> dict[str, str]:
    """Read, profile, clean, write and measure; returns the path of every written table.

    Clean tables are Parquet; profiles, audits, the diagnostic and results
    are single sorted CSV files, as they are small.
    """
    raw = {"postings": read_postings(spark, postings_csv), "layoffs": files.read_quoted_csv(spark, layoffs_csv),
           "job_skills": files.read_quoted_csv(spark, job_skills_csv), "skills": files.read_quoted_csv(spark, skills_csv),
           "jolts": read_jolts(spark, series_files)}
    written, audits = write_clean_tables(raw, f"{out_dir}/parquet")
    paths = {f"parquet/{name}": path for name, path in written.items()}
    postings, layoffs, bridge, jolts = (spark.read.parquet(written[n]) for n in ("postings", "layoffs", "skills", "jolts"))
    profiles = {"postings": profile_postings(raw["postings"]), "layoffs": profile_layoffs(raw["layoffs"]),
                "skills": profile_skills(raw["job_skills"], raw["skills"]), "jolts": profile_series(raw["jolts"])}
    tagged = tag_postings(postings, layoffs)

    def counts(*by: str) -> DataFrame:
        return tag_posting_counts(postings, layoffs, list(by))

    tables = {
        **{f"profiles/{n}": (p, ["dataset", "column", "metric"]) for n, p in profiles.items()},
        **{f"audits/{n}": (audit, ["metric"]) for n, audit in audits.items()},
        "diagnostics/join_hit_rate": (join_diagnostic(postings, layoffs), ["position"]),
        "results/median_salary_by_level": (median_salary_by_level(tagged), ["experience_level", "subcohort"]),
        "results/experience_level_share": (experience_level_share(counts("formatted_experience_level"), "n"), ["experience_level", "subcohort"]),
        "results/top_skills": (top_skills(tagged, bridge), ["subcohort", "-n", "skill_name"]),
        "results/tech_skill_share": (tech_skill_share(tagged, bridge), ["subcohort"]),
        "results/remote_rate": (remote_rate(counts("remote_allowed"), "n"), ["subcohort"]),
        "results/top_states": (top_states(counts("state"), weight="n"), ["subcohort", "-n", "state"]),
        "results/layoff_rate": (layoff_rate_series(jolts), ["industry", "obs_date"]),
        "results/openings_hires": (openings_hires_series(jolts), ["industry", "obs_date"]),
    }
    for name, (df, order) in tables.items():
        by = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order]
        paths[name] = sinks.write_single_csv(df, f"{out_dir}/{name}", by)
    return paths
