"""DataFrame operators. Each one is lazy unless its docstring says that it
fits something; fitted objects are small and bounded (vocabularies, caps,
medians, edges) and are applied as literals in a narrow projection."""
