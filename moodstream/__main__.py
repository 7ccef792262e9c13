"""Command line: ``python -m moodstream train|score|merge|dashboard ...`` or with spark-submit."""

from __future__ import annotations

import argparse

from moodstream.plans import model, workflows
from moodstream.session import build_session
from moodstream.sinks.files import preview


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="moodstream")
    commands = parser.add_subparsers(dest="command", required=True)
    train = commands.add_parser("train", help="train on labelled CSV files and save the model")
    train.add_argument("paths", nargs="+")
    train.add_argument("--model", required=True)
    train.add_argument("--classifier", choices=("regression", "bayes"), default="regression")
    score = commands.add_parser("score", help="score a one-column CSV with a saved model")
    score.add_argument("path")
    score.add_argument("--model", required=True)
    score.add_argument("--out", required=True)
    score.add_argument("--classifier", choices=("regression", "bayes"), default="regression")
    merge = commands.add_parser("merge", help="merge the CSV files of a folder")
    merge.add_argument("folder")
    merge.add_argument("--out", required=True)
    board = commands.add_parser("dashboard", help="show the summary of archived scored batches")
    board.add_argument("folder")
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = build_session()
    bayes = getattr(args, "classifier", "") == "bayes"
    features = model.BAG_OF_WORDS if bayes else model.TFIDF
    if args.command == "train":
        classifier = model.naive_bayes() if bayes else model.logistic_regression()
        run = workflows.train_from_csv(spark, args.paths, args.model, features, classifier)
        run.distribution.show()
        print(f"f1 {run.f1:.4f}  accuracy {run.accuracy:.4f}")
    elif args.command == "score":
        scored = workflows.score_csv(spark, args.path, model.load(args.model), features)
        scored.select("Sentence", "prediction", "class").write.mode("overwrite").parquet(args.out)
    elif args.command == "merge":
        workflows.merge_csv(spark, args.folder, args.out)
    else:
        for name, table in workflows.archive_dashboard(spark, args.folder).items():
            print(name)
            preview(table, 50)


if __name__ == "__main__":
    main()
