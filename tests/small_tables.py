"""Folders of the driver's tables that the tests read (a module of its own: every
folder of tests may have a ``conftest``)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
