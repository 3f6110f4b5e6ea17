"""Reading feeds, storing datasets, maintaining and publishing them."""
