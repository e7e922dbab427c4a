"""The flows: collecting functions, making datasets, evaluating predictions."""
