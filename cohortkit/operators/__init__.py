"""DataFrame operators: profile, rules, keys, cohort, measures, series, integrity, resample, fuzzy."""
