"""Jobs built from the operators: model tables, training, scoring, generation."""
