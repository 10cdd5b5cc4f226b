"""Jobs built from the operators: facts, dimensions, marts, quality, profiling, exploration."""
