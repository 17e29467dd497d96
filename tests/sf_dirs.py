"""Folders of the given tables. Tests import them from here, never from a
``conftest``: every folder of tests may have one of its own."""

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
