"""Short public notices by which texts name their license.

At a share of 0.75, a notice that differs from another in few words is reported with it, at a lower containment:
an LGPL or AGPL line also gives GPL-3.0 (0.8), the two Creative Commons sentences give each other.
"""

NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "Apache-2.0-header",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "MIT-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so",
    ),
    (
        "BSD-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    (
        "GPL-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("All-rights-reserved", "All rights reserved."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-terms", "under the terms of the GNU Lesser General Public License as published by"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-terms", "under the terms of the GNU Affero General Public License as published by"),
    ("ISC", "Released under the ISC License."),
    (
        "ISC-text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-style", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    (
        "CC0-waiver",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
    ),
    ("CC-BY-4.0-short", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0-short", "Licensed under CC BY-SA 4.0."),
)
