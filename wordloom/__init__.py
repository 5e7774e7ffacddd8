"""N-gram language modelling as Spark jobs: corpus -> counts -> probabilities -> next words."""
