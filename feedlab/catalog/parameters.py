"""Parameters of the named queries, shared with the SQL they are checked against."""

AS_OF = "2024-01-22"
NEW_USERS_AS_OF = "2024-01-03"
RETENTION_AS_OF = "2024-01-03"
CURVE_AS_OF = "2024-01-29"
CURVE_AGE = 28
PEAK_DAY = "2024-01-15"
ALERT_AS_OF = "2024-01-21 12:07:00"
LITERAL_DAY = "2024-01-21"
MERGE_FROM = "2024-01-24"

AA_WEEK = ("2024-01-08", "2024-01-14")
AB_WEEK = ("2024-01-15", "2024-01-21")
AA_PAIR = (2, 3)
AB_PAIR = (1, 2)
OTHER_PAIR = (0, 3)
BUCKETS = 50

ITERATIONS = 10_000
SAMPLE = 500
SMALL_SAMPLE = 15  # as many as the feed groups of the small test tables have
AA_SEED = "aa"
REPLICATES = 2_000
BOOTSTRAP_SEED = "boot"
PVALUE_BINS = 50
AUDIENCE = 10_000
HASH = "md5"
