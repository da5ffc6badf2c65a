"""Multi-step jobs: features, training, and the whole flow."""
