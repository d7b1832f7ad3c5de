"""Message triage on Spark: from unlabelled multilingual messages to categories, classifier and reports."""
