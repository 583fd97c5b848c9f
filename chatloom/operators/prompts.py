"""Sample wording for the generators: short neutral prompts and phrases for our own tables.

All of it is a caller's input. A slot's phrases rotate (see ``chatloom.operators.pools``); ``{}`` is filled
by position, ``[]`` marks the place a request names its dish.
"""
from __future__ import annotations

SYSTEM = "Do the task below. Output the result only."

# ---- rating ----------------------------------------------------------------------------------
EVAL_INTRO = "Recipe:\n\n"
EVAL_REVIEWS = "Comments:\n\n"
EVAL_WHY = "Explain a score of {} out of 5 from the recipe alone."
EVAL_GATE = "Is there a change that several comments ask for?"
EVAL_CRITIQUE = "Name those changes in a short paragraph."

# ---- recipe chat -----------------------------------------------------------------------------
RECIPE_INTRO = "Text:\n\n"
RECIPE_TITLE = 'Title: "{}". Put a short name of the dish for [] in: "{}"'
SECRET_FIRST = "Which step matters most here?"
SECRET_MORE = "Which one comes next?"
SECRET_JUDGE = "Is that obvious?"
SECRET_SUMMARY = "Shorten:\n\n"

# ---- article questions -----------------------------------------------------------------------
ARTICLE_INTRO = "Text:\n\n"
ARTICLE_CLASS = "Choose a label for the text: anecdotes, story, knowledge."
ARTICLE_QUESTIONS = "Write a numbered list of questions, one per line, to which the text has the answer."
ARTICLE_ANSWER = 'Answer from the text, at length: "{}"'

YES_NO = ["yes", "no"]
ARTICLE_CLASSES = ["anecdotes", "story", "knowledge"]

# Question lines containing any of these substrings are dropped.
BANNED_QUESTION_WORDS = ["in the recipe", "article", "this", "that", "these", "those", "author", "her", "his"]

POOLS: dict[str, list] = {
    "ask_rating": ["Score, please?", "How many points out of five?", "Rate it."],
    "rating_high": ["{} of 5. {}", "A high score: {} of 5. {}"],
    "rating_low": ["{} of 5. {}", "A low score: {} of 5. {}"],
    "rating_mid": ["{} of 5. {}", "In between: {} of 5. {}"],
    "ask_changes": ["What should change?", "Name some changes."],
    "request": [["Show me []", "."], ["I need []", ", please."], ["Steps for []", "?"]],
    "ask_nutrition": ["Nutrition table?", "List the nutrients."],
    "ask_cuisine": ["Cuisine?", "Name the cuisine."],
    "tell_cuisine": ["Cuisine: ", "Its cuisine is "],
    "ask_category": ["Category?", "Name the category."],
    "tell_category": ["Category: ", "Its category is "],
    "ask_time": ["Time?", "Minutes or hours?"],
    "tell_both_times": ["Preparation {}, total {}.", "{} to prepare, {} overall."],
    "tell_preparation": ["Preparation {}.", "{} to prepare."],
    "tell_total": ["Total {}.", "{} overall."],
    "ask_tips": ["Tips?", "Name the main points."],
}
