"""Licence notices to be found in documents.  Fixed values, in plain text:
the public wording of each notice.  A name may have several notices."""

NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU GPL v3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License
as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "Licensed under the GNU GPL v2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer."""),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the
names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED"""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies."""),
    ("Zlib", """Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim
that you wrote the original software."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means."""),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("reserved", "Copyright. All rights reserved."),
    ("reserved", "All rights reserved."),
]

# What tells a licence from its kin (name, variant, version): those of these phrases that a notice has must stand in the text word for word.
TELLING = {
    "MIT": ["MIT License", "permission notice", "License-Identifier: MIT"],
    "Apache-2.0": ["Apache License, Version 2.0", "License-Identifier: Apache-2.0"],
    "GPL-3.0": ["GNU General Public License", "GNU General Public License, version 3", "version 3", "the GNU GPL v3", "License-Identifier: GPL-3.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "the GNU GPL v2", "License-Identifier: GPL-2.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0"],
    "CC0-1.0": ["waived all copyright"],
    "BSD-3-Clause": ["source and binary forms", "License-Identifier: BSD-3-Clause", "endorse or promote products"],
    "BSD-2-Clause": ["source and binary forms", "License-Identifier: BSD-2-Clause", "the distribution. THIS SOFTWARE IS PROVIDED"],
    "ISC": ["with or without fee is hereby granted"],
    "Zlib": ["Permission is granted to anyone to use this software"],
    "Unlicense": ["unencumbered software released into the public domain"],
    "EPL-2.0": ["Eclipse Public License 2.0"],
    "BSL-1.0": ["Boost Software License, Version 1.0"],
    "MPL-2.0": ["Mozilla Public License, v. 2.0"],
    "reserved": ["all rights reserved"],
}
