"""Training-data operators: each module has one operator, its query and its SQL where SQL can express it."""
