"""Folders of the given tables. An ordinary module: both test folders have a conftest."""

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
