"""cohortkit: cohort comparison on Spark DataFrames.

Profile a table, clean it with audited rules, canonicalise join keys, tag a
fact table by membership in a second dataset, compare the cohorts (median,
share, rate, top-k, contrasts, resampled baselines) and reshape coded
monthly series.  Functions take and return DataFrames or Columns built from
built-in Spark functions; plans are lazy, except that sinks write, and that the
exact median and the median baselines write their counted values first.
"""

from cohortkit.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
