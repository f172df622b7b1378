"""Column expressions: text, time, labels and money. None of them needs Python on executors."""
