"""Command line: python -m tagloom.cli COMMAND --config FILE."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import SparkSession

from .plans.stages import Config, Run

COMMANDS: dict[str, tuple[Callable[[Run], object], ...]] = {
    "generate-data": (Run.generate_data,),
    "analyze-data": (Run.analyze,),
    "sample": (Run.sample,),
    "download": (Run.download,),
    "deduplicate": (Run.deduplicate,),
    "sample-faces": (Run.sample_faces,),
    "crop-faces": (Run.crop_faces,),
    "classify": (Run.classify,),
    "generate-prompts": (Run.generate_prompts,),
    "unified-aes-prompts": (Run.unified,),
    "upsample-prompts": (Run.upsample,),
    "encode-latents": (lambda r: r.encode("latents", encoder=True),),
    "encode-tag-weights": (Run.tag_weights, lambda r: r.encode_weights("latents")),
    "encode-hq-latents": (Run.prepare_hq, lambda r: r.encode("hq_latents", encoder=True)),
    "encode-hq-tag-weights": (Run.prepare_hq, Run.tag_weights, lambda r: r.encode_weights("hq_latents")),
    "encode-raw-images": (Run.export,),
    "sync-tiers": (Run.sync_tiers,),
    "full-pipeline": (Run.generate_data, Run.sample, Run.download, Run.unified, Run.generate_prompts, Run.tag_weights, lambda r: r.encode("latents", encoder=True)),
}


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tagloom", description=__doc__)
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--config", required=True, help="YAML (or JSON) file with the fields of plans.stages.Config")
    given = parser.parse_args(args)
    run = Run(SparkSession.builder.appName(f"tagloom {given.command}").getOrCreate(), Config.read(given.config))
    for stage in COMMANDS[given.command]:
        stage(run)


if __name__ == "__main__":
    main()
