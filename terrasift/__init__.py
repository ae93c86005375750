"""terrasift: data preparation, quality gates and reconciliation as Spark plans."""
