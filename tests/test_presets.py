"""The reference workload on literal fixtures (edge rows from FIXTURES.md)."""

import datetime as dt

from cohortkit import presets
from cohortkit.sources.files import all_strings
from tests.conftest import rows


def _postings(spark):
    base = dict.fromkeys(presets.POSTING_COLUMNS)
    data = [
        dict(base, job_id="1", company_name="Acme Inc.", location="Princeton, NJ", remote_allowed="1.0",
             min_salary="50000", max_salary="90000", normalized_salary="80000", currency="USD",
             formatted_experience_level="Entry level", original_listed_time="1713397508000.0"),
        dict(base, job_id="2", company_name="X Corp", location="United States", remote_allowed=None,
             normalized_salary="120000", currency="USD", formatted_experience_level="Entry level"),
        dict(base, job_id="3", company_name="Other LLC", location="Austin, TX", remote_allowed="0",
             min_salary="100", max_salary="50", normalized_salary="60000", currency="USD",
             formatted_experience_level="Director"),
        dict(base, job_id="4", company_name="Other LLC", location="Austin, TX", remote_allowed="1",
             normalized_salary="5000", currency="USD", formatted_experience_level="Director"),
        dict(base, job_id="5", company_name=None, location="Austin, TX", normalized_salary="70000",
             currency="USD", formatted_experience_level="Director"),
        dict(base, job_id="6", company_name="Other LLC", location="Austin, TX", normalized_salary="70000",
             currency="USD", formatted_experience_level="Director"),
    ]
    return spark.createDataFrame([tuple(d[c] for c in presets.POSTING_COLUMNS) for d in data],
                                 all_strings(presets.POSTING_COLUMNS))


def _layoffs(spark):
    data = [("Acme", "SF", "100", "4/16/2023", None, "Tech", "Post-IPO", "US"),
            ("Twitter", "SF", None, "4/31/2023", "0.5", "Tech", "Private", "US"),
            ("Ghost Inc", "NY", None, "", None, "Retail", "Seed", "US")]
    return spark.createDataFrame(data, all_strings(presets.LAYOFF_COLUMNS))


def test_postings_pipeline(spark):
    postings, audit = presets.clean_postings(_postings(spark))
    a = {m: v for _, m, v in rows(audit)}
    assert a["dropped_min_salary_gt_max_salary"] == 1 and a["dropped_normalized_salary_out_of_bounds"] == 1
    assert a["final_row_count"] == 4
    p = {r[0]: r[1:] for r in rows(postings, "job_id", "city", "state", "remote_allowed", "listed_date",
                                    "company_normalized")}
    assert p["1"] == ("princeton", "nj", True, dt.date(2024, 4, 17), "acme")
    assert p["2"] == ("united states", None, False, None, "x")

    layoffs, la = presets.clean_layoffs(_layoffs(spark))
    assert {m: v for _, m, v in rows(la)}["dropped_both_laid_off_fields_null"] == 1
    assert sorted(rows(layoffs, "company_normalized", "date"), key=str) == [("acme", dt.date(2023, 4, 16)),
                                                                             ("twitter", None)]
    tagged = presets.tag_postings(postings, layoffs)
    got = sorted(rows(tagged, "job_id", "subcohort"))
    # job 2 is X Corp -> "x" -> alias "twitter" (a member); job 5 has no company and is dropped
    assert got == [("1", "layoff_affected"), ("2", "layoff_affected"), ("6", "non_affected")]
    med = rows(presets.median_salary_by_level(tagged), "subcohort", "experience_level", "median_salary",
               "posting_count")
    assert med == [("non_affected", "Director", 70000.0, 1), ("layoff_affected", "Entry level", 80000.0, 2)]
    rr = rows(presets.remote_rate(tagged), "subcohort", "total_postings", "remote_postings", "remote_pct")
    assert rr == [("layoff_affected", 2, 1, 50.0), ("non_affected", 1, 0, 0.0)]
    st = rows(presets.top_states(tagged), "subcohort", "state", "n", "pct_of_subcohort")
    assert st == [("layoff_affected", "nj", 1, 100.0), ("non_affected", "tx", 1, 100.0)]


def test_skills_bridge(spark):
    js = spark.createDataFrame([("1", "ENG"), ("1", "ENG"), ("1", "SALE"), ("2", "ZZZ")], "job_id string, skill_abr string")
    sk = spark.createDataFrame([("ENG", "Engineering"), ("SALE", "Sales")], "skill_abr string, skill_name string")
    bridge, audit = presets.clean_skills(js, sk)
    assert sorted(rows(bridge)) == [("1", "ENG", "Engineering"), ("1", "SALE", "Sales")]
    a = {m: v for _, m, v in rows(audit)}
    assert a == {"post_join_row_count": 4, "dropped_orphaned_skill_codes": 1,
                 "dropped_duplicate_job_skill_pairs": 1, "row_count": 2}
    tagged = spark.createDataFrame([("1", "layoff_affected")], "job_id string, subcohort string")
    share = rows(presets.tech_skill_share(tagged, bridge))
    assert share == [("layoff_affected", 2, 1, 50.0)]


def test_series_preset(spark):
    raw = spark.createDataFrame([("JTS510000000000000LDR", "2023", "M07", "1.1"),
                                 ("JTS510000000000000LDR", "2023", "M13", "1.0"),
                                 ("JTS510000000000000QUR", "2023", "M07", "9.9")],
                                "series_id string, year string, period string, value string")
    s, audit = presets.clean_series(raw)
    assert rows(presets.layoff_rate_series(s)) == [(dt.date(2023, 7, 1), 2023, 7, "Information", 1.1)]
    a = {m: v for _, m, v in rows(audit)}
    assert a["dropped_non_target_series"] == 1 and a["dropped_period_m13"] == 1


def test_top_skills_share_and_tie_break(spark):
    tagged = spark.createDataFrame([("1", "layoff_affected"), ("2", "layoff_affected")], "job_id string, subcohort string")
    bridge = spark.createDataFrame([("1", "ENG", "Engineering"), ("1", "SALE", "Sales"), ("2", "ENG", "Engineering"),
                                    ("2", "ADM", "Administrative")], "job_id string, skill_abr string, skill_name string")
    got = rows(presets.top_skills(tagged, bridge, k=2))
    # Engineering 2 of 4 tags; Administrative and Sales tie at 1, the lower name is kept
    assert got == [("layoff_affected", "Engineering", 2, 50.0), ("layoff_affected", "Administrative", 1, 25.0)]


def _write(path, text):
    path.write_text(text)
    return str(path)


def test_whole_run_from_files(spark, tmp_path):
    cols = presets.POSTING_COLUMNS
    lines = [",".join(cols)]
    for i, company in enumerate(['"Acme Inc."', '""', "Other LLC", "Acme"]):
        row = dict.fromkeys(cols, "")
        row.update(job_id=str(i), company_name=company, location='"Austin, TX"', remote_allowed="1" if i % 2 else "",
                   normalized_salary="60000", currency="USD", formatted_experience_level="Director")
        lines.append(",".join(row[c] for c in cols))
    postings = _write(tmp_path / "postings.csv", "\n".join(lines) + "\n")
    job_skills = _write(tmp_path / "job_skills.csv", "job_id,skill_abr\n0,ENG\n2,IT\n2,ZZZ\n")
    skills = _write(tmp_path / "skills.csv", "skill_abr,skill_name\nENG,Engineering\nIT,Information\n")
    layoffs = _write(tmp_path / "layoffs.csv", ",".join(presets.LAYOFF_COLUMNS) + "\nAcme,SF,100,4/16/2023,,Tech,IPO,US\n")
    series = [_write(tmp_path / f"s{i}.tsv", f"series_id  \tyear\tperiod\t  value\tfootnote_codes\nJTS000000000000000{e}R  \t2023\tM01\t  1.{i}\t\n")
              for i, e in enumerate(["JO", "HI", "LD"])]
    out = presets.run(spark, postings, job_skills, skills, layoffs, series, str(tmp_path / "out"))

    def read(name):
        return {tuple(r) for r in spark.read.option("header", True).csv(out[name]).collect()}

    # the quoted blank company is NULL, so its posting belongs to neither cohort
    assert read("results/remote_rate") == {("layoff_affected", "2", "1", "50.0"), ("non_affected", "1", "0", "0.0")}
    profile = {(c, m): v for _, c, m, v in read("profiles/postings")}
    assert profile["company_name", "null_count"] == "1" and profile["_dataset", "row_count"] == "4"
    assert profile["currency", "top_1_value"] == "USD" and profile["normalized_salary", "mean"] == "60000.00"
    assert ("3", "matched_keys", "1") in read("diagnostics/join_hit_rate")
    assert len(read("results/openings_hires")) == 1 and len(read("results/layoff_rate")) == 1
    assert spark.read.parquet(out["parquet/skills"]).count() == 2


def test_remote_rate_reads_only_its_columns(spark, tmp_path):
    from tests.conftest import plan_text

    postings, _ = presets.clean_postings(_postings(spark))
    layoffs, _ = presets.clean_layoffs(_layoffs(spark))
    postings.write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    plain = presets.remote_rate(presets.tag_postings(stored, layoffs))
    counted = presets.remote_rate(presets.tag_posting_counts(stored, layoffs, ["remote_allowed"]), "n")
    for df in (plain, counted):
        assert "ReadSchema: struct<remote_allowed:boolean,company_normalized:string>" in plan_text(df)
    assert rows(plain) == rows(counted)
