"""Ready-made jobs: transformation, load, seed and the questions asked of the star."""
