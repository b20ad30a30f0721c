"""The run by stages on a small table, with injected functions."""

import json

import pytest

from tagloom import cli
from tagloom.plans.stages import Config, Run
from tagloom.sources.posts import posts

SF = "/root/testdata/sf0.001"


def tag_scores(paths):
    return [[0.9, 0.1, 0.2, 0.3, 0.8, 0.7] for _ in paths]


@pytest.fixture
def run(spark, tmp_path):
    rows = posts(spark, SF)
    rows.drop("aes_score").write.parquet(str(tmp_path / "posts"))
    rows.selectExpr("id", "aes_score AS score").write.parquet(str(tmp_path / "scores.parquet"))
    images = tmp_path / "img"
    images.mkdir()
    for i in range(200):
        (images / f"{i}.png").write_bytes(b"x")
    return Run(spark, Config(work=f"file://{tmp_path}/work", posts=str(tmp_path / "posts"), scores=f"file://{tmp_path}/scores.parquet", images=str(images), artists=["src0"], total=40, functions={"both": f"{__name__}:tag_scores"}, names=["smile", "sky"], categories=[0, 0]))


def test_run(run):
    assert run.analyze().count() > 0
    sampled = run.sample()
    assert 0 < sampled.count() <= 40
    assert run.unified().count() > 0
    prompts = run.generate_prompts()
    assert prompts.count() == sampled.count()
    assert run.tag_weights().filter("weight <= 0").count() == 0
    run.encode()
    assert run.export().columns[:3] == ["booru_id", "image", "prompt"]
    assert run.sample_faces().count() > 0
    with pytest.raises(LookupError, match="download"):
        run.download()


def test_cli(run, tmp_path, spark):
    config = tmp_path / "c.json"
    config.write_text(json.dumps({k: v for k, v in vars(run.config).items()}))
    cli.main(["sample-faces", "--config", str(config)])
    assert run.table("faces").count() > 0
    assert len(cli.COMMANDS) == 18
