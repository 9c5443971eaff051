"""Start the live queries: `python -m vigil.plans.live --source_path ... --root ...`."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from vigil.config import Settings
from vigil.functions.codec import with_event_time
from vigil.operators.scoring import anomaly_lines, collection_lines
from vigil.operators.training import trained_lines
from vigil.session import build_session
from vigil.sources.messages import read_messages
from vigil.sources.sinks import line_sink
from vigil.streaming import jobs


def start_all(spark: SparkSession, settings: Settings, root: str) -> list[StreamingQuery]:
    """Ingest and train as two queries over one message source and one store.

    Collections, new models and anomalies each leave a line in the store's line table.
    """
    store = jobs.Store.under(f"{root}/tables", settings)
    messages = read_messages(spark, settings)
    trained = line_sink(store.lines, "trained", trained_lines)
    saved = line_sink(store.lines, "saved", lambda models: trained_lines(models, "MODEL SAVED"))
    collected = line_sink(
        store.lines, "collected", lambda rows: collection_lines(with_event_time(rows), settings.training_window))
    found = line_sink(
        store.lines, "anomalies", lambda rows: anomaly_lines(with_event_time(rows), settings.score_window))
    return [
        jobs.start_ingesting(messages, store, f"{root}/checkpoints/ingest", settings, sinks=[found]),
        jobs.start_training(
            messages, store, f"{root}/checkpoints/train", settings, sinks=[trained, saved], taps=[collected]),
    ]


def parse(argv: list[str] | None = None) -> tuple[Settings, str]:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", required=True, help="shared folder for tables and checkpoints")
    parser.add_argument("--source_format", default="text", help="any streaming source, such as text or kafka")
    parser.add_argument("--source_path", help="folder of message files")
    parser.add_argument("--source_option", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--model_load_timer", type=int, default=120, help="seconds between catalog refreshes")
    args = parser.parse_args(argv)
    options = dict(option.split("=", 1) for option in args.source_option)
    settings = Settings(
        source_format=args.source_format, source_path=args.source_path, source_options=options,
        refresh_ms=args.model_load_timer * 1000,
    )
    return settings, args.root


def main(argv: list[str] | None = None) -> None:
    settings, root = parse(argv)
    spark = build_session("vigil-live")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(f"{root}/scratch")
    start_all(spark, settings, root)
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
