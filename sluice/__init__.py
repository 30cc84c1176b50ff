"""Batch enrichment of semi-structured data on PySpark."""

from sluice.operators.grouping import group_agg, group_apply, group_fields, group_frames, with_group_key
from sluice.operators.modules import BatchModule, map_batches, merge_fields
from sluice.plans.inputs import Input, load_inputs, typed
from sluice.plans.job import Job
from sluice.plans.script import register_frames, run_script
from sluice.plans.stages import Stage, run_stages
from sluice.session import build_session, ship_package
from sluice.sources.files import Parser, scan_binary, scan_files, scan_parsed
from sluice.sources.json_objects import scan_json_objects
from sluice.sources.raw_files import Storage
from sluice.sources.tables import scan_lines, scan_service, scan_text

__all__ = [
    "BatchModule",
    "Input",
    "Job",
    "Parser",
    "Stage",
    "Storage",
    "build_session",
    "group_agg",
    "group_apply",
    "group_fields",
    "group_frames",
    "load_inputs",
    "map_batches",
    "merge_fields",
    "register_frames",
    "run_script",
    "run_stages",
    "scan_binary",
    "scan_files",
    "scan_json_objects",
    "scan_lines",
    "scan_parsed",
    "scan_service",
    "scan_text",
    "ship_package",
    "typed",
    "with_group_key",
]
