"""Folders of the given tables. A module of its own name: ``conftest`` names whichever file pytest imported first."""

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"
