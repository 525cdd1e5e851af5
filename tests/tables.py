"""The test-table folders the tests read."""

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
