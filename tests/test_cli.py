"""Command line: experiment, train and score on CSV files, as the reference's scripts are run."""

import os

from kestrel.cli import main
from kestrel.sources.fixtures import ART_CAT, art

SF = "/root/testdata/sf0.001"
NUM = ["x1", "x2", "t0", "t1", "t2", "t3", "t4"]


def test_cli_experiment_train_score(spark, tmp_path, capsys):
    labelled = art(spark, SF).select("id", *NUM, *ART_CAT, "shares", "y")
    train_csv = str(tmp_path / "train.csv")
    labelled.coalesce(1).write.option("header", True).csv(train_csv)
    test_csv = str(tmp_path / "test.csv")
    labelled.drop("shares", "y").coalesce(1).write.option("header", True).csv(test_csv)
    common = ["--data", train_csv, "--cat-cols", "cat1,cat2"]

    assert main(["experiment", *common, "--model", "naive_bayes", "--metrics-out", str(tmp_path / "m")]) == 0
    assert "holdout" in capsys.readouterr().out

    out = str(tmp_path / "run")
    assert main(["train", *common, "--out", out, "--n-iter", "1", "--folds", "2", "--search-iterations", "3",
                 "--final-iterations", "6", "--patience", "3", "--derivations", "none"]) == 0
    text = capsys.readouterr().out
    assert "best trial" in text and "composite=" in text

    pred = str(tmp_path / "pred")
    assert main(["score", "--data", test_csv, "--cat-cols", "cat1,cat2", "--model", os.path.join(out, "model"),
                 "--out", pred]) == 0
    assert f"{labelled.count()} rows" in capsys.readouterr().out
    assert main(["score", "--data", str(tmp_path / "missing.csv"), "--model", os.path.join(out, "model"),
                 "--out", pred]) == 2
