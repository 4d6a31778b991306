"""Where the tests find their data."""

STAR = "/root/testdata/sf0.001"
