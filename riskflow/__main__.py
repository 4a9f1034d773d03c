"""Command line: ``python -m riskflow <job> --root <shared folder> [options]``.

Jobs: train, retrain, drift, gauges, medallion, score. Folders under ``--root``: bronze,
silver, quarantine, gold, features, predictions, rejects, model_runs, models, gauges,
_checkpoints. ``--source kafka --servers host:9092 --topic transactions_raw`` reads Kafka
(connector jar required); the default reads a folder of raw JSON lines (``--raw``).
"""

from __future__ import annotations

import argparse
import time

from .plans.jobs import MODEL_NAME, Paths, drift_job, gauges_job, retrain_job, train_job
from .streaming.scoring import PREDICTION_TOPIC, RAW_TOPIC


def main(argv=None):
    ap = argparse.ArgumentParser(prog="riskflow")
    ap.add_argument("job", choices=["train", "retrain", "drift", "gauges", "medallion", "score"])
    ap.add_argument("--root", required=True)
    ap.add_argument("--raw", help="folder of raw JSON lines (file source)")
    ap.add_argument("--source", default="text", choices=["text", "json", "kafka"])
    ap.add_argument("--servers")
    ap.add_argument("--topic", default=RAW_TOPIC)
    ap.add_argument("--kafka-out", action="store_true",
                    help="score: also publish prediction records to --predictions-topic")
    ap.add_argument("--predictions-topic", default=PREDICTION_TOPIC)
    ap.add_argument("--once", action="store_true", help="process what is available and stop")
    ap.add_argument("--no-retrain", action="store_true")
    ap.add_argument("--order", default="time", choices=["time", "arrival"],
                    help="drift: cut the log by inference time or in order of arrival")
    ap.add_argument("--preset", default="store", choices=["store", "online"],
                    help="score: which consumer's features are scored")
    ap.add_argument("--record", default="rich", choices=["rich", "short"])
    ap.add_argument("--every", type=float, default=0,
                    help="drift/gauges: run again every N seconds until interrupted (STR6)")
    a = ap.parse_args(argv)

    from .session import build_session
    spark = build_session()
    r = a.root.rstrip("/")
    paths = Paths(features=f"{r}/features", predictions=f"{r}/predictions",
                  runs=f"{r}/model_runs", models=f"{r}/models", gauges=f"{r}/gauges")
    trigger = {"availableNow": True} if a.once else None
    if a.job == "train":
        train_job(spark, paths).show(truncate=False)
    elif a.job == "retrain":
        retrain_job(spark, paths).show(truncate=False)
    elif a.job in ("drift", "gauges"):
        while True:
            if a.job == "drift":
                report, decision, _ = drift_job(spark, paths, retrain=not a.no_retrain, order=a.order)
                report.show(truncate=False)
                print(decision)
                report.unpersist()
            else:
                gauges_job(spark, paths).show(truncate=False)
            if a.every <= 0:
                break
            time.sleep(a.every)
    else:
        from .functions.features import PRESETS
        from .sources.raw import read_raw_stream
        from .streaming import (ChampionLoader, bronze_query, gold_query, scoring_query,
                                silver_query)
        raw = read_raw_stream(spark, a.source, a.raw, servers=a.servers, topic=a.topic)
        chk = f"{r}/_checkpoints"
        if a.job == "medallion":
            qs = [bronze_query(raw, f"{r}/bronze", f"{chk}/bronze", trigger)]
            if a.once:
                qs[0].awaitTermination()
            qs.append(silver_query(spark, f"{r}/bronze", f"{r}/silver", f"{r}/quarantine",
                                   f"{chk}/silver", trigger))
            if a.once:
                qs[1].awaitTermination()
            qs.append(gold_query(spark, f"{r}/silver", f"{r}/gold", f"{chk}/gold", trigger))
        else:
            champ = ChampionLoader(spark, paths.runs, MODEL_NAME)
            kafka = ({"servers": a.servers, "topic": a.predictions_topic}
                     if a.kafka_out else None)
            qs = [scoring_query(raw, paths.features, paths.predictions, f"{r}/rejects",
                                f"{chk}/scoring", champion=champ, trigger=trigger,
                                kafka=kafka, spec=PRESETS[a.preset], record=a.record)]
        if a.once:
            for q in qs:
                q.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
