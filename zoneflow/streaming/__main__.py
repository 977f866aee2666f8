"""Run the stream: python -m zoneflow.streaming --topic events --output s3a://lake --checkpoints s3a://lake/ckpt"""

from __future__ import annotations

import argparse

from zoneflow.session import build_spark
from zoneflow.streaming.windows import StreamConfig, run_stream


def main() -> None:
    parser = argparse.ArgumentParser(description="Clean events and publish zone window metrics")
    parser.add_argument("--servers", default="localhost:9092")
    parser.add_argument("--topic", required=True)
    parser.add_argument("--starting-offsets", default="latest")
    parser.add_argument("--output", required=True)
    parser.add_argument("--checkpoints", required=True)
    parser.add_argument("--dedup", choices=("exact", "bloom"), default="exact")
    parser.add_argument("--run-seconds", type=float, default=0, help="stop after this time; 0 runs until stopped")
    parser.add_argument("--max-per-trigger", type=int, help="offsets that one micro-batch takes at most")
    args = parser.parse_args()
    run_stream(build_spark("zoneflow-stream"), StreamConfig(
        bronze=f"{args.output}/bronze", silver=f"{args.output}/silver", checkpoints=args.checkpoints,
        source_options={
            "kafka__bootstrap__servers": args.servers, "subscribe": args.topic, "startingOffsets": args.starting_offsets,
        },
        run_seconds=args.run_seconds, dedup=args.dedup, max_per_trigger=args.max_per_trigger,
    ))


if __name__ == "__main__":
    main()
