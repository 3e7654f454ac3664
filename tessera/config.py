"""Run settings: defaults, a YAML file, the command line, in rising order of force; checked once."""

from __future__ import annotations

import argparse
import dataclasses
import os
from dataclasses import dataclass, field

#: What each choice accepts.
OUTPUT_FORMATS = ("png", "parquet", "h5", None)
NORMALISERS = ("macenko", "reinhard", "stainnet", None)
EXTRACTORS = ("resnet50", "resnet50_truncated", "mahmood-uni", "empty", "moments")
SIZING = ("magnification", "mpp")
RESAMPLERS = ("bilinear", "area", "linear")


@dataclass(frozen=True)
class RunConfig:
    input_path: str | None = field(default=None, metadata={"flags": ("-i",), "help": "slide file or folder"})
    output_path: str | None = field(default=None, metadata={"flags": ("-o",), "help": "folder for results"})
    output_format: str | None = field(default="parquet", metadata={"help": "png, parquet (h5 is taken as parquet), or none to encode without saving tiles"})
    desired_size: int = field(default=256, metadata={"flags": ("-s",), "help": "tile side in pixels"})
    desired_magnification: float = field(default=20, metadata={"flags": ("-m",), "help": "target magnification"})
    desired_mpp: float | None = field(default=None, metadata={"help": "target microns per pixel, for sizing by mpp"})
    sizing_scale: str = field(default="magnification", metadata={"help": "magnification or mpp"})
    overlap: int = field(default=1, metadata={"flags": ("-ov",), "help": "stride is size // overlap"})
    set_standard_magnification: float | None = field(default=None, metadata={"help": "magnification of slides whose header has none"})
    set_standard_mpp: float | None = field(default=None, metadata={"help": "mpp of slides whose header has none"})
    tissue_threshold: float = field(default=0.7, metadata={"flags": ("-th",), "help": "least share of tissue in a tile, inclusive"})
    mask_scale: int | None = field(default=None, metadata={"help": "downscale of the thumbnail; at most 64 by default"})
    masks: tuple[str, ...] = field(default=("otsu", "blue", "red", "green", "black", "gray"), metadata={"help": "masks to combine; folds is optional"})
    red_pen_thresh: float = 0.4
    blue_pen_thresh: float = 0.4
    remove_folds: bool = False
    remove_blurry_tiles: bool = field(default=False, metadata={"flags": ("-rb",), "help": "drop blurry tiles"})
    blur_threshold: float = field(default=0.015, metadata={"flags": ("-bh",), "help": "tiles of at most this variance are blurry"})
    normaliser: str | None = field(default=None, metadata={"flags": ("-n",), "help": "macenko, reinhard or stainnet (needs a registered model)"})
    encode: bool = field(default=False, metadata={"flags": ("-e",), "help": "encode tiles"})
    feature_extractor: str = field(default="moments", metadata={"help": "name of a registered encoder"})
    augmentations: int = field(default=0, metadata={"help": "augmented copies of each tile"})
    extract_high_quality: bool = field(default=False, metadata={"help": "also keep the layer before the last"})
    batch_size: int = 16
    min_tiles: int = field(default=0, metadata={"help": "slides with fewer passing tiles leave the manifest"})
    reader: str = field(default="synthetic", metadata={"help": "name of a registered slide reader"})
    reconstruct_slide: bool = field(default=False, metadata={"help": "write thumbnails with the kept tiles framed and the others black"})
    resampler: str = "bilinear"
    compat: bool = field(default=False, metadata={"help": "reproduce known quirks of older runs instead of the documented intent"})
    seed: int = 0

    def __post_init__(self) -> None:
        wrong = [
            f"{name}: {value!r}"
            for name, value, ok in (
                ("output_format", self.output_format, self.output_format in OUTPUT_FORMATS),
                ("normaliser", self.normaliser, self.normaliser in NORMALISERS),
                ("sizing_scale", self.sizing_scale, self.sizing_scale in SIZING),
                ("desired_mpp", self.desired_mpp, self.sizing_scale != "mpp" or self.desired_mpp),
                ("overlap", self.overlap, self.overlap >= 1),
                ("desired_size", self.desired_size, self.desired_size >= 1),
                ("tissue_threshold", self.tissue_threshold, 0 <= self.tissue_threshold <= 1),
                ("resampler", self.resampler, self.resampler in RESAMPLERS),
                ("augmentations", self.augmentations, self.augmentations >= 0),
            )
            if not ok
        ]
        if wrong:
            raise ValueError("unusable settings: " + ", ".join(wrong))

    @property
    def encode_batch(self) -> int:
        """Tiles a batch, when each stands for itself and its augmented copies."""
        return -(-self.batch_size // (self.augmentations + 1))

    @classmethod
    def from_yaml(cls, path: str, **over) -> RunConfig:
        """Settings of a YAML file; unknown keys are an error, nulls mean the default."""
        import yaml

        with open(path) as f:
            found = {k: v for k, v in (yaml.safe_load(f) or {}).items() if v is not None} | over
        known = {f.name for f in dataclasses.fields(cls)}
        if unknown := sorted(set(found) - known):
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        if isinstance(found.get("masks"), list):
            found["masks"] = tuple(found["masks"])
        return cls(**found)

    @classmethod
    def from_args(cls, args: list[str] | None = None) -> RunConfig:
        """The command line over the YAML file of --config over the defaults."""
        parser = argparse.ArgumentParser(description="Prepare whole-slide images: mask, tile, check, normalise, encode, report.")
        parser.add_argument("--config", help="YAML file of settings")
        for f in dataclasses.fields(cls):
            kind, default = str(f.type), f.default
            how: dict = {"default": None, "help": f.metadata.get("help", f"default: {default}")}
            if kind == "bool":
                how["action"] = "store_true"
            elif kind.startswith("tuple"):
                how["type"] = lambda s: tuple(s.split(","))
            else:
                how["type"] = {"int": int, "float": float}.get(kind.split(" ")[0], str)
            parser.add_argument(*f.metadata.get("flags", ()), f"--{f.name}", **how)
        got = vars(parser.parse_args(args))
        path = got.pop("config")
        over = {k: (None if v == "none" else v) for k, v in got.items() if v is not None}
        return cls.from_yaml(path, **over) if path else cls(**over)


def write_template(path: str) -> None:
    """A commented YAML file of all settings at their defaults."""
    lines = []
    for f in dataclasses.fields(RunConfig):
        value = f.default
        text = "null" if value is None else str(value).lower() if isinstance(value, bool) else "[" + ", ".join(value) + "]" if isinstance(value, tuple) else str(value)
        lines.append(f"# {f.metadata['help']}\n{f.name}: {text}\n" if "help" in f.metadata else f"{f.name}: {text}\n")
    with open(path, "w") as out:
        out.write("\n".join(lines))


def cores() -> int:
    return os.cpu_count() or 1
