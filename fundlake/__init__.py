"""Exchange-traded-fund data as Spark jobs: landed responses in, clean tables out."""
