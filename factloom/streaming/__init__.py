"""Empty on purpose: facts come from finished file trees, so every operator is a batch DataFrame."""
