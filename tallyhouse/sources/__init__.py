"""Where rows come from: files, databases, parameterised SQL and the entity frames."""
