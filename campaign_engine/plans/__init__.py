"""Jobs composed of operators: cleaning, training, scoring, feature search."""
