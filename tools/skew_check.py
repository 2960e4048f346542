"""Hot-key check: a third of all postings on one account, per-task shuffle volume per stage.

Postings are derived from the given tables (the sf0.1 fixture) and every
third one is moved to account 1.  The turnover jobs run with Spark's event
log written to a fresh scratch folder; the log's task records give, per
stage, the largest and the median number of shuffle records a task read or
wrote.  A stage where one task received the hot account's rows would show a
largest/median ratio far above 1.

Usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tallyspark.operators import turnover as TO  # noqa: E402
from tallyspark.session import SCALE_CONF  # noqa: E402
from tallyspark.sources.fixtures import Fixtures  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="skew-eventlog-")
    b = (SparkSession.builder.master("local[8]").appName("skew-check")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.sql.shuffle.partitions", "16")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
         .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false"))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    f = Fixtures(spark, sf_dir)
    hot = F.xxhash64("oper_date", "credit_account_rk", "debet_account_rk") % 3 == 0
    # The hot third: one account on one day.
    postings = (f.ft_posting_f
                .withColumn("credit_account_rk", F.when(hot, F.lit(1)).otherwise(F.col("credit_account_rk")))
                .withColumn("oper_date", F.when(hot, F.lit("1998-09-15").cast("date")).otherwise(F.col("oper_date"))))
    accounts = f.md_account_d
    rates = f.md_exchange_rate_d
    total = postings.count()
    on_hot = postings.filter(F.col("credit_account_rk") == 1).count()
    jobs = {
        "turnover_all_days": TO.account_turnover_range(postings, accounts, rates),
        "turnover_one_day": TO.account_turnover(postings, accounts, rates, "1998-09-15"),
    }
    for name, df in jobs.items():
        spark.sparkContext.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()

    stages: dict[int, list[tuple[int, int]]] = {}
    stage_job: dict[int, str] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = group
                    continue
                if ev.get("Event") != "SparkListenerTaskEnd":
                    continue
                m = ev.get("Task Metrics") or {}
                read = (m.get("Shuffle Read Metrics") or {})
                wrote = (m.get("Shuffle Write Metrics") or {})
                rec_in = read.get("Total Records Read", 0)
                rec_out = wrote.get("Shuffle Records Written", 0)
                stages.setdefault(ev["Stage ID"], []).append((rec_in, rec_out))
    print(f"postings: {total}, on the hot account: {on_hot} ({on_hot / max(total, 1):.0%})")
    print(f"{'job':>18} {'stage':>5} {'tasks':>5} {'max read':>9} {'med read':>9} {'max write':>9} {'med write':>9}")
    worst = 1.0
    for sid in sorted(stages):
        if stage_job.get(sid) not in jobs:
            continue
        recs = stages[sid]
        reads = [r for r, _ in recs]
        writes = [w for _, w in recs]
        if max(reads) == 0 and max(writes) == 0:
            continue
        if len(recs) > 1:
            for vals in (reads, writes):
                med = statistics.median(vals)
                if med > 0:
                    worst = max(worst, max(vals) / med)
        print(f"{stage_job[sid]:>18} {sid:>5} {len(recs):>5} {max(reads):>9} {int(statistics.median(reads)):>9} "
              f"{max(writes):>9} {int(statistics.median(writes)):>9}")
    print(f"worst largest/median task shuffle records over multi-task stages: {worst:.2f}")


if __name__ == "__main__":
    main()
