from rivulet.plans import catalog  # noqa: F401
