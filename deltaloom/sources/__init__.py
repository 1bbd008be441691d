"""Where change rows come from: files, databases, messages, log segments."""
