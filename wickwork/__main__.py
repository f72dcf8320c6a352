"""Command line: ``python -m wickwork {batch,train,collect,live,merge} ...``."""

from __future__ import annotations

import argparse

from wickwork.session import build_session


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="wickwork")
    jobs = top.add_subparsers(dest="job", required=True)

    batch = jobs.add_parser("batch", help="raw lines to features, report, CSV and a model")
    batch.add_argument("--input", required=True)
    batch.add_argument("--output", required=True)
    batch.add_argument("--model")

    train = jobs.add_parser("train", help="fit the model on feature CSV files")
    train.add_argument("--input", required=True)
    train.add_argument("--output", required=True)

    collect = jobs.add_parser("collect", help="append closed kline messages as records")
    collect.add_argument("--input", required=True, help="folder of message lines")
    collect.add_argument("--history", help="folder of earlier records to keep beside the stream's")
    collect.add_argument("--output", required=True)
    collect.add_argument("--state", required=True)
    collect.add_argument("--duration", type=float, default=300)

    live = jobs.add_parser("live", help="messages to candles, features, scores and outcomes")
    live.add_argument("--input", required=True)
    live.add_argument("--output", required=True)
    live.add_argument("--state", required=True)
    live.add_argument("--model")
    live.add_argument("--history", help="folder of records loaded before the start")
    live.add_argument("--duration", type=float, help="seconds; default: read what is there")
    live.add_argument("--delay", default="2 minutes", help="how late a candle may arrive")
    live.add_argument("--chunk", default="month", help="calendar unit a series is cut into")
    live.add_argument("--max-files", type=int, help="files in a micro-batch; default: all there are")
    live.add_argument("--beats", action="store_true", help="complete candles by the clock on a quiet stream")

    merge = jobs.add_parser("merge", help="bring late and corrected candles that landed into stored features")
    merge.add_argument("--input", required=True, help="output folder of the live job")
    merge.add_argument("--output", required=True)
    return top


def run_batch_job(spark, args) -> None:
    from wickwork.plans.batch import run_batch

    done = run_batch(spark, args.input, args.output, model_path=args.model)
    done.report.orderBy("check", "key").show(100, truncate=False)
    if done.evaluation is not None:
        done.evaluation.show()


def run_train_job(spark, args) -> None:
    from wickwork.plans.batch import train_from_csv

    _, evaluation = train_from_csv(spark, args.input, args.output)
    if evaluation is None:
        print("not enough rows to train on")
    else:
        evaluation.show()


def run_collect_job(spark, args) -> None:
    from wickwork.sinks.files import collect_closed, write_history
    from wickwork.sources.files import read_collected
    from wickwork.sources.messages import read_lines, stream_lines

    if args.history:
        write_history(read_lines(spark, args.history), args.output)
    known = read_collected(spark, args.output)
    query = collect_closed(stream_lines(spark, args.input), args.output, args.state, within="1 day", history=known)
    query.awaitTermination(args.duration)
    query.stop()


def run_live_job(spark, args) -> None:
    from wickwork.operators.training import load_model
    from wickwork.sources.messages import load_candles, read_lines, stream_lines
    from wickwork.streaming.landing import Landing
    from wickwork.streaming.live import LiveJob, heartbeats, kline_candles

    model = load_model(args.model) if args.model else None
    job = LiveJob(spark, args.output, args.state, model=model, chunk=args.chunk)
    if args.history:
        job.seed(load_candles(spark, args.history))
    # A run that ends with its input has no quiet time to pass.
    beats = heartbeats(spark) if args.beats and args.duration is not None else None
    landing = Landing(spark, args.output, args.state)
    landed = landing.start(stream_lines(spark, args.input, args.max_files), args.duration is None)
    job.run(
        stream_lines(spark, args.input, args.max_files),
        lambda lines: kline_candles(lines, args.delay, beats),
        flush_from=read_lines(spark, args.input),
        timeout=args.duration,
    )
    if args.duration is None:
        landed.awaitTermination()
    landed.stop()
    landing.counts().show()
    job.written().show()


def run_merge_job(spark, args) -> None:
    from wickwork.streaming.landing import Landing
    from wickwork.streaming.merge import FeatureStore

    store = FeatureStore(spark, args.output)
    state = store.follow(Landing(spark, args.input, args.output))
    print(f"commit {state.number}, landed up to batch {state.note}")


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"wickwork-{args.job}")
    jobs = {
        "batch": run_batch_job,
        "train": run_train_job,
        "collect": run_collect_job,
        "live": run_live_job,
        "merge": run_merge_job,
    }
    jobs[args.job](spark, args)


if __name__ == "__main__":
    main()
