"""A model for tests."""


def write(prompt, key):
    return f"{key} wrote: {prompt}"


def speak(prompt):
    """JSON as models write it; prose for one cell."""
    animal, mood = prompt.split()[5], prompt.split()[8]
    return "Sorry!" if (animal, mood) == ("cat", "angry") or (animal, mood) == ("dog", "happy") else f"```json\n{{'transformed_content': '{animal} {mood}', \"more\": [1,"
