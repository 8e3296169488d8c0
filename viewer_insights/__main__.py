"""Command line: run the staged batch job.

    python -m viewer_insights --search-log /data/log_search --months t6=202206 t7=202207 \\
        --viewing-log '/data/log_content/*.json' --rules rules.csv [--reviewed reviewed.csv] \\
        --out /shared/out [--top-n 5000] [--how full] [--fold-diacritics] \\
        [--sample-users 5000 --sample-seed 0] [--days-per-month 30] [--jdbc-from-env --jdbc-connections 8] [--rejects]

Uses the active Spark session (``spark-submit`` sets master and options).
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from viewer_insights import vocab
from viewer_insights.functions.rules import MAX_RULE_PHRASES
from viewer_insights.operators.sizing import DEFAULT_SALT_BUCKETS
from viewer_insights.plans import customer360 as plan
from viewer_insights.plans import jobs
from viewer_insights.sinks import jdbc
from viewer_insights.sources import dictionary, logs


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="viewer_insights", description=__doc__.splitlines()[0])
    p.add_argument("--search-log", required=True, help="folder of YYYYMMDD/ day folders")
    p.add_argument("--months", nargs=2, required=True, metavar="LABEL=YYYYMM", help="month A and month B")
    p.add_argument("--viewing-log", required=True, help="glob of YYYYMMDD.json files")
    p.add_argument("--rules", required=True, help="rule table CSV: priority,category,phrase")
    p.add_argument("--reviewed", help="reviewed dictionary CSV (the exported sheet, filled in)")
    p.add_argument("--out", required=True, help="output folder on shared storage")
    p.add_argument("--top-n", type=int, default=None, help="keep only the n best-scored search users")
    p.add_argument("--how", default="full", choices=["full", "inner", "left", "right"])
    p.add_argument("--fold-diacritics", action="store_true", help="match rules on keywords without accents")
    p.add_argument("--max-rule-phrases", type=int, default=MAX_RULE_PHRASES, help="refuse a longer rule table")
    p.add_argument("--salt-buckets", type=int, default=DEFAULT_SALT_BUCKETS, help="tasks that share a hot keyword")
    p.add_argument("--sample-users", type=int, default=None, help="keep a sample of n viewing users")
    p.add_argument("--sample-seed", type=int, default=0)
    p.add_argument("--days-per-month", type=int, default=vocab.DAYS_PER_MONTH, help="days that Active 100 stands for")
    p.add_argument("--jdbc-from-env", action="store_true", help="publish to MySQL configured by DB_* variables")
    p.add_argument("--jdbc-connections", type=int, help="connections open at once (with --jdbc-from-env)")
    p.add_argument("--insights", action="store_true", help="also write the business questions as CSV")
    p.add_argument("--rejects", action="store_true", help="also write the lines of the viewing log that can't be read")
    a = p.parse_args(argv)
    if a.jdbc_from_env and not a.jdbc_connections:
        p.error("--jdbc-from-env needs --jdbc-connections")
    return a


def main(argv=None, spark: SparkSession | None = None) -> dict:
    a = parse_args(argv)
    spark = spark or SparkSession.builder.appName("viewer-insights").getOrCreate()
    months = dict(m.split("=", 1) for m in a.months)
    labels = tuple(months)
    log = logs.read_search_log(spark, a.search_log, months)
    events = logs.read_viewing_log(spark, a.viewing_log)
    rules = dictionary.read_rule_table(spark, a.rules, max_phrases=a.max_rule_phrases)
    manual = dictionary.read_manual_dictionary(spark, a.reviewed) if a.reviewed else None
    s = plan.SearchSettings(labels=labels, rules=rules, top_n=a.top_n, salt_buckets=a.salt_buckets,
                            fold_diacritics=a.fold_diacritics)
    target = jdbc.mysql_target_from_env(a.jdbc_connections) if a.jdbc_from_env else None
    v = plan.ViewingSettings(days=a.days_per_month, sample_n=a.sample_users, sample_seed=a.sample_seed)
    out = jobs.Outputs(a.out)
    counts = jobs.run_all(spark, log, events, s, v, out, manual, a.how, target)
    if a.rejects:
        counts["rejects"] = jobs.export_rejects(spark, a.viewing_log, out)
    if a.insights:
        counts["insights"] = len(jobs.run_insights(spark, out, s, v))
    print(json.dumps(counts))
    return counts


if __name__ == "__main__":
    main()
