"""Where data comes from and goes to: pages, bloc configuration, boundaries, result files, star-schema tables."""
