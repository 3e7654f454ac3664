"""Declared schemas of every table the engine reads or writes, as DDL; nothing is inferred."""

from __future__ import annotations

SLIDES = "slide_id string, path string, vendor string, objective_power string, mpp_x string, mpp_y string, width int, height int, level_downsamples array<double>"
MANIFEST = "`Patient ID` string, `Original Slide Path` string, `Preprocessing Path` string"
PIXELS = "slide_id string, x int, y int, r smallint, g smallint, b smallint"
MASK = "slide_id string, mx int, my int, tissue boolean"
TILES = "slide_id string, x int, y int, tile_path string, original_size struct<w:int,h:int>, desired_size int, desired_magnification int, original_mag double, scale int, laplacian_var double"
TILE_STORE = "slide_id string, x int, y int, size int, tile binary, error string"
FEATURES = "slide_id string, x int, y int, tile_path string, features array<float>"
AUGMENTED_FEATURES = "slide_id string, x int, y int, tile_path string, features array<array<float>>"
SUMMARY = (
    "sample_id string, path string, total_tiles int, tiles_passing_tissue_thresh int, non_blurry_tiles int, time_masking_cpu double, time_obtaining_valid_coordinates_cpu double, time_patching_tiles_cpu double, time_masking_user double, "
    "time_obtaining_valid_coordinates_user double, time_patching_tiles_user double, status string, `%_tissue` double, `%_tiles_passing_QC` double, total_time_cpu double, total_time_user double, encoding_cpu_time double, encoding_user_time double"
)
ERRORS = "`Sample ID` string, Path string, Error string, `Step in Pipeline` string"
