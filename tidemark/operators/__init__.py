"""DataFrame -> DataFrame building blocks on long and wide panels."""
