"""The registered queries, each with the SQL that has to give the same rows."""

from workload import clustering, files, further, naming, patients, preprocessing, quality, scans, tests_of_markers, triads, typing
from workload.registry import REGISTRY

__all__ = ["REGISTRY", "clustering", "files", "further", "naming", "patients", "preprocessing", "quality", "scans",
           "tests_of_markers", "triads", "typing"]
