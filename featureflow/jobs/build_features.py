"""Build the train/test feature tables once (split, fit on train, apply to both)."""

from __future__ import annotations

from featureflow.jobs.common import PRESETS, base_parser, load_table, session
from featureflow.plans import features as feat
from featureflow.sources import io


def main(argv=None):
    p = base_parser("Split, learn preprocessing parameters on train, write train/test feature tables")
    p.add_argument("--raw_flights", required=True)
    p.add_argument("--raw_plane", default=None)
    p.add_argument("--out", required=True, help="folder for features.parquet (partitions is_train=true and false) and params")
    p.add_argument("--train_frac", type=float, default=0.8)
    p.add_argument("--split_key", default=None, help="hash split on this column (default: randomSplit)")
    p.add_argument("--frequency_threshold", type=float, default=0.02)
    p.add_argument("--cardinality_threshold", type=int, default=10)
    p.add_argument("--strategy", choices=["mean", "ignore"], default="mean")
    p.add_argument("--sample", type=float, default=None, help="debug: sample this fraction with replacement")
    p.add_argument("--most_rejects", type=float, default=None,
                   help="keep malformed CSV records apart and fail above this share (default: their bad fields are NULL)")
    args = p.parse_args(argv)
    spark = session(args, "featureflow-build")
    spec = PRESETS[args.preset]
    fact = load_table(spark, args.raw_flights, f"{args.out}/ingest", "fact", spec, args.most_rejects)
    dim = load_table(spark, args.raw_plane, f"{args.out}/ingest", "dim", spec) if args.raw_plane else None
    io.validate_dataset(fact, spec.label)
    if args.sample:
        fact = fact.sample(withReplacement=True, fraction=args.sample, seed=42)
    train, test = feat.build_feature_table(
        fact, dim, spec, args.out, train_frac=args.train_frac, split_key=args.split_key, reuse=False,
        frequency_threshold=args.frequency_threshold, cardinality_threshold=args.cardinality_threshold,
        high_cardinality_strategy=args.strategy)
    print(f"train rows: {train.count()}  test rows: {test.count()}")


if __name__ == "__main__":
    main()
